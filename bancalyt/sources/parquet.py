"""Parquet source: one directory (or file) per logical table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from bancalyt.sources.schema import SCHEMAS
from bancalyt.sources.tables import BankTables


def _read(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Spark's own reader decides what exists, wherever ``base`` is."""
    try:
        return spark.read.parquet(f"{base}/{name}")
    except AnalysisException as missing:
        try:
            return spark.read.parquet(f"{base}/{name}.parquet")
        except AnalysisException:
            raise missing from None


def load_parquet(spark: SparkSession, base: str) -> BankTables:
    """Read the eight tables from ``base/<Table>`` (or ``<Table>.parquet``).

    Files are read with their own types (one footer each table) and cast to
    the declared ones by ``conform``, so that exports with money as double or
    flags as 0/1 are read too; the scan only reads the columns a query needs.
    A table is looked up when a query first touches it.
    """
    return BankTables.from_mapping({name: (lambda n=name: _read(spark, base, n)) for name in SCHEMAS})


def write_parquet(tables: BankTables, base: str, mode: str = "errorifexists") -> None:
    """Write each table to ``base/<Table>``; facts partitioned by nothing.

    Spark writes one file per task, so the output is as parallel as the
    plan that produced the frames.
    """
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{base}/{name}")
