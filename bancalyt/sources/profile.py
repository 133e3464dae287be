"""Source checks: row count per table and a schema report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bancalyt.sources.schema import SCHEMAS
from bancalyt.sources.tables import BankTables


def source_profile(tables: BankTables) -> DataFrame:
    """``(tabla, filas, error)``: the row count of every table, or why it cannot
    be planned.

    A lazy union of eight counts: nothing runs until the result is used.  A count
    reads no column, so Parquet tables are counted from their footers; only one-row
    results meet in the union.  A table that is not there, or whose columns do
    not fit, has a null count and the first line of its error and does not fail
    the others; a file that turns out to be broken when it is read fails the run."""
    spark = SparkSession.getActiveSession()
    counts = []
    for name in SCHEMAS:
        label = F.lit(name).alias("tabla")
        try:
            df = tables.table(name)
            counts.append(df.agg(F.count(F.lit(1)).alias("filas")).select(label, "filas", F.lit(None).cast("string").alias("error")))
        except Exception as error:  # noqa: BLE001 - whatever the source says is the result
            said = str(error).strip().splitlines()[0][:300] if str(error).strip() else type(error).__name__
            counts.append(spark.range(1).select(label, F.lit(None).cast("long").alias("filas"), F.lit(said).alias("error")))
    return reduce(DataFrame.unionByName, counts)


def schema_report(spark: SparkSession, tables: BankTables) -> DataFrame:
    """``(tabla, columna, tipo, nullable)`` from the tables' schemas (metadata
    only; no data is read)."""
    rows = [
        (name, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for f in df.schema.fields
    ]
    schema = T.StructType([
        T.StructField("tabla", T.StringType()),
        T.StructField("columna", T.StringType()),
        T.StructField("tipo", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
    ])
    return spark.createDataFrame(rows, schema)
