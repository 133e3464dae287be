"""Catalog tables bucketed on the customer key.

Every per-customer join of the catalogue (customers with accounts, loans,
scores and contracts) and every per-customer pre-aggregation is keyed on
``id_cliente``.  Writing those five tables bucketed by ``id_cliente`` into
the same number of buckets lets Spark plan those joins and aggregates
without any shuffle of the fact tables: bucket i of every table is read by
the same task.  The small dimensions are written plainly.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from bancalyt.sources.schema import SCHEMAS
from bancalyt.sources.tables import BankTables

CUSTOMER_KEY = "id_cliente"
# tables co-located on the customer key
CO_LOCATED = ("Clientes", "Cuentas", "Prestamos", "ScoreCliente", "ClienteProductos")


def save_bucketed(tables: BankTables, database: str, buckets: int, path: str,
                  mode: str = "overwrite") -> None:
    """Save the eight tables as ``database.<Table>``; the customer-keyed ones
    bucketed and sorted by ``id_cliente`` into ``buckets`` buckets.

    Size ``buckets`` so that one bucket of the largest table is a few
    hundred MB.  ``path`` is where the files go, on storage that all executors
    share.  A bucket is one task and has no shuffle that adaptive execution
    could split: a customer with a large share of all rows makes its bucket
    that large.  Use this layout only for data without such customers; from
    unbucketed tables the queries salt them.
    """
    spark = tables.clientes.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        writer = df.write.mode(mode).format("parquet")
        if name in CO_LOCATED:
            writer = writer.bucketBy(buckets, CUSTOMER_KEY).sortBy(CUSTOMER_KEY)
        writer.option("path", f"{path}/{name}").saveAsTable(f"{database}.{name}")


def load_catalog(spark: SparkSession, database: str) -> BankTables:
    """The eight tables from the catalog (bucketing metadata included)."""
    return BankTables.from_mapping(
        {name: (lambda n=name: spark.table(f"{database}.{n}")) for name in SCHEMAS})
