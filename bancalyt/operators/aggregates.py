"""Aggregate-shaped operators: share of total, indicator rates, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def share_of_total(df: DataFrame, value: str, out: str = "pct", decimals: int = 1,
                   scale: int = 100) -> DataFrame:
    """``round(value * scale / sum(value over all rows), decimals)``.

    The total is a scalar subquery: a two-phase aggregate over the same
    rollup, whose shuffle adaptive execution reuses, so the facts are read
    once and rows are never gathered into one partition.  A zero total gives
    null instead of a division error.
    """
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(out, F.round(F.try_divide(F.col(value) * F.lit(scale), total), decimals))


def indicator_rates(df: DataFrame, keys: Sequence[str], flags: Mapping[str, str],
                    decimals: int = 1) -> DataFrame:
    """Per group, the percentage of rows where each boolean flag is true
    (mean of the 0/1 indicator; null flags are skipped)."""
    return df.groupBy(*keys).agg(*[
        F.round(F.avg(F.col(flag).cast("int")) * 100, decimals).cast("double").alias(name)
        for name, flag in flags.items()
    ])


#: pivot columns that the data may name
MAX_COLUMNS = 500


def pivot_columns(df: DataFrame, column: str, limit: int = MAX_COLUMNS) -> list[str]:
    """The different values of ``column``, in order: one small job, whose result is
    bounded; more than ``limit`` values are refused, not cut."""
    found = sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values: group by it instead of making each a column")
    return found


def pivot_counts(df: DataFrame, rows: Sequence[str], column: str, value: str,
                 values: Sequence[str] | None, fill: int = 0, other: str | None = None) -> DataFrame:
    """Matrix ``rows x values`` of ``sum(value)``; a missing cell is ``fill``.

    With given pivot values Spark plans a single aggregation and the output
    schema is fixed; ``other`` then names a column for what has none of these
    values, so that no row of ``df`` is left out of its row's cells.  With
    ``values=None`` the data name the columns (:func:`pivot_columns`).
    """
    if values is None:
        values, other = pivot_columns(df, column), None
    cells = [*values]
    if other is not None:
        cells.append(other)
        named = F.col(column).isin(*values)
        df = df.withColumn(column, F.when(named, F.col(column)).otherwise(F.lit(other)))
    if not cells:
        return df.select(*rows).distinct()
    wide = df.groupBy(*rows).pivot(column, cells).agg(F.sum(value))
    return wide.na.fill(fill, subset=cells)
