"""bancalyt: retail-banking analytics expressed as Spark DataFrame plans.

Layout
------
sources/    typed logical tables (parquet, partitioned JDBC, test-data mapping),
            source profile, result sinks
functions/  Column-level helpers (tier ladders, age, full name, money rounding)
operators/  DataFrame -> DataFrame building blocks (top-k, top-n per group,
            neighbour difference, exclusion, group metrics, share of total, pivot)
plans/      the named queries of the catalogue, their registry and the DuckDB
            oracle SQL used as a correctness check
"""

from bancalyt.sources.tables import BankTables

__all__ = ["BankTables"]
__version__ = "0.1.0"
