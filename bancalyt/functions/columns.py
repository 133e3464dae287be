"""Column-level helpers.  All return built-in Spark expressions, so they
stay inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_name(first: ColumnOrName = "nombre", last: ColumnOrName = "apellidos") -> Column:
    """``first || ' ' || last``; null when either part is null (SQL CONCAT)."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def money(c: ColumnOrName, decimals: int = 2) -> Column:
    """Round a decimal amount half-up and emit it as double for the result."""
    return F.round(_col(c), decimals).cast("double")


@dataclass(frozen=True)
class Tier:
    """One rung of a threshold ladder: ``value > bound`` (or ``>=`` when
    ``inclusive``) yields ``label``."""

    bound: float
    label: str
    inclusive: bool = False


def tier_classify(value: ColumnOrName, ladder: Sequence[Tier], default: str) -> Column:
    """CASE over a ladder of thresholds, first match wins; a null value
    matches no rung and falls to ``default`` (as SQL CASE does)."""
    v = _col(value)
    out = None
    for t in ladder:
        cond = v >= t.bound if t.inclusive else v > t.bound
        out = F.when(cond, t.label) if out is None else out.when(cond, t.label)
    return F.lit(default) if out is None else out.otherwise(default)


def rule_classify(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """CASE over arbitrary predicates, first match wins."""
    out = None
    for cond, label in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.lit(default) if out is None else out.otherwise(default)


def as_of_column(as_of: _dt.date | str | Column | None) -> Column:
    """The reference date of a query; ``None`` means today (non-repeatable,
    so the registered queries always pin a date)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def age_years(dob: ColumnOrName, as_of: _dt.date | str | Column | None = None,
              mode: str = "calendar") -> Column:
    """Age in whole years at ``as_of``.

    ``calendar``: completed calendar years (SQL ``TIMESTAMPDIFF(YEAR, ...)``).
    ``days365``: ``floor(days / 365)``, the approximation of the catalogue's
    DataFrame code; it drifts by a year around birthdays.
    """
    ref = as_of_column(as_of)
    if mode == "calendar":
        return F.timestamp_diff("YEAR", _col(dob), ref)
    if mode == "days365":
        return F.floor(F.datediff(ref, _col(dob)) / 365)
    raise ValueError(f"unknown age mode {mode!r}")


def count_flags(*flags: ColumnOrName) -> Column:
    """Number of true flags (boolean cast to int and added; null if any flag
    is null, as in SQL arithmetic)."""
    total = None
    for f in flags:
        term = _col(f).cast("int")
        total = term if total is None else total + term
    return total
