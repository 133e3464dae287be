"""Distinct counts by HyperLogLog sketches, which merge: one sketch per finest
group is built once (one per task and group, however hot the group) and rolled up
to any coarser one without reading the rows again."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's size: 16,384 registers, a relative standard error of 0.8 %
LG_SIZE = 14


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, lg_size: int = LG_SIZE) -> DataFrame:
    """``(keys, _sketch)`` of the different values of ``column``; nulls do not count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_size).alias("_sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of the groups ``keys`` (none: one for all) from finer ones."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("_sketch").alias("_sketch"))


def estimated() -> Column:
    return F.hll_sketch_estimate("_sketch")


def error_bound(lg_size: int = LG_SIZE, deviations: float = 5) -> float:
    """The relative error that ``deviations`` standard errors allow."""
    return deviations * 1.04 / math.sqrt(2 ** lg_size)
