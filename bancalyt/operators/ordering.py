"""Ordering operators: top-k, ranks, top-n per group, neighbour difference.

Scale notes
-----------
A window partitioned by a low-cardinality key (branch, province) puts a
whole group into one task; with one branch holding a third of all accounts
that task would sort a third of the table.  So none of these operators
runs an unbounded window:

* ``top_k`` is ``orderBy().limit()``, planned as TakeOrderedAndProject: every
  partition keeps its own k best rows and only ``k x partitions`` rows meet.
* ``rank_all`` ranks every row (and gives its lag / lead) over ranges of about
  equal size, cut where the data says (see its docstring).
* ``rank_within`` and ``neighbor_diff`` serve ordered reports of the first k
  rows of ``(group, order, tie-break)``.  Every row that precedes a reported
  row inside its group is itself among those k rows, so ranks, dense ranks,
  row numbers and lags computed on the k-row head are exact; the window then
  runs over k rows.  (A lead needs ``offset`` more rows; they are taken too.)
* ``top_n_per_group`` filters on the rank right after the window, which
  Catalyst turns into a partial WindowGroupLimit before the shuffle and a
  final one after it: each map task ships at most n rows (plus ties) per
  group, however big the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bancalyt.operators.scratch import written

RANK_FUNCTIONS = {
    "rank": F.rank,
    "dense_rank": F.dense_rank,
    "row_number": F.row_number,
}


def _asc(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def sort_spec(order: Sequence[Column], tie_break: Sequence[str] = ()) -> list[Column]:
    """The full ordering: ``order`` followed by the ascending tie-break keys."""
    return [*order, *_asc(tie_break)]


def top_k(df: DataFrame, order: Sequence[Column], k: int | None,
          tie_break: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows by ``order`` then ``tie_break``; all rows, in no
    order, when ``k`` is None (a whole result is not range-shuffled for its
    display order).  Ending the order with a unique key makes the cut
    deterministic."""
    return df if k is None else df.orderBy(*sort_spec(order, tie_break)).limit(k)


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
                tie_break: Sequence[str] = (),
                kinds: Mapping[str, str] | None = None) -> DataFrame:
    """Ranks of each row inside its ``by`` group for the first ``k`` rows of
    the order ``(by, order, tie_break)``.

    ``kinds`` maps output column -> ``rank`` / ``dense_rank`` / ``row_number``.
    ``rank`` and ``dense_rank`` order by ``order`` only (ties share a rank);
    ``row_number`` also uses ``tie_break`` so it is deterministic.
    """
    if k is None or k < 0:
        raise ValueError("rank_within reports the first k rows; pass k >= 0")
    kinds = kinds or {"rnk": "rank", "dense_rnk": "dense_rank", "row_num": "row_number"}
    full = [*_asc(by), *order]
    head = top_k(df, full, k, tie_break)
    w_ties = Window.partitionBy(*by).orderBy(*order)
    w_total = Window.partitionBy(*by).orderBy(*sort_spec(order, tie_break))
    ranked = head.withColumns({
        out: RANK_FUNCTIONS[kind]().over(w_total if kind == "row_number" else w_ties).cast("long")
        for out, kind in kinds.items()
    })
    return ranked.orderBy(*sort_spec(full, tie_break))


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                    method: str = "rank", tie_break: Sequence[str] = (),
                    out: str = "ranking") -> DataFrame:
    """Rows whose ``method`` rank inside their ``by`` group is ``<= n``.

    ``rank`` / ``dense_rank`` keep ties, so a group may return more than n
    rows; ``row_number`` returns at most n, cut by ``tie_break``.
    """
    if method not in RANK_FUNCTIONS:
        raise ValueError(f"unknown rank method {method!r}")
    spec = sort_spec(order, tie_break) if method == "row_number" else list(order)
    w = Window.partitionBy(*by).orderBy(*spec)
    return (df.withColumn(out, RANK_FUNCTIONS[method]().over(w))
              .where(F.col(out) <= n)
              .withColumn(out, F.col(out).cast("long")))


def neighbor_diff(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str,
                  k: int, tie_break: Sequence[str] = (), offset: int = 1, default=None,
                  direction: str = "lag", neighbor_out: str = "saldo_anterior",
                  diff_out: str = "diferencia", decimals: int | None = 2) -> DataFrame:
    """Value of the row ``offset`` places before (``lag``) or after (``lead``)
    inside the ``by`` group, and ``value - neighbour``, for the first ``k``
    rows of ``(by, order, tie_break)``."""
    if direction not in ("lag", "lead"):
        raise ValueError(f"unknown direction {direction!r}")
    if k is None or k < 0:
        raise ValueError("neighbor_diff reports the first k rows; pass k >= 0")
    full = [*_asc(by), *order]
    extra = offset if direction == "lead" else 0
    head = top_k(df, full, k + extra, tie_break)
    w = Window.partitionBy(*by).orderBy(*sort_spec(order, tie_break))
    fn = F.lag if direction == "lag" else F.lead
    neighbour = fn(value, offset, default).over(w)
    diff = F.col(value) - F.col(neighbor_out)
    if decimals is not None:
        diff = F.round(diff, decimals)
    out = head.withColumn(neighbor_out, neighbour).withColumn(diff_out, diff)
    return top_k(out, full, k, tie_break)


def rank_all(df: DataFrame, by: Sequence[str], value: str, row_id: str,
             kinds: Mapping[str, str] | None = None, lag_out: str | None = None,
             lead_out: str | None = None, default=None, parts: int | None = None) -> DataFrame:
    """Rank, dense rank, row number, previous and next value of every row
    inside its ``by`` group, by ``value`` descending (nulls last) then
    ``row_id`` ascending (nulls first), with no step that holds a whole group
    in one task.

    The rows are cut into ranges of (group, value, id) of about equal size, at
    bounds that Spark samples from the data, so neither sparse ids nor a value
    shared by a third of the rows make a large range.  The ranges are written
    once to the shared folder with their number, so that every later step
    agrees on them.  Windows run inside (group, range); a range's summary (rows,
    distinct values, first and last value, start of its last run of ties) is one
    row, and prefix sums over the summaries of a group, in order, give what
    stands before each range.  A run of ties that goes on from the range before
    takes the rank at which it began there.

    Account rows are shuffled twice: into ranges, and for the windows, whose
    partitioning also serves the join with the prefix sums.  ``rank`` and
    ``dense_rank`` use the value only; ``row_number``, lag and lead also
    ``row_id``, a unique key.  ``default`` is the lag / lead of a row without a
    neighbour.  ``parts`` fixes the number of ranges (by default that of the
    session's shuffles, small ones joined by adaptive execution).
    """
    kinds = dict(kinds if kinds is not None else {"rnk": "rank", "dense_rnk": "dense_rank", "row_num": "row_number"})
    order = [*_asc(by), F.col(value).desc_nulls_last(), F.col(row_id).asc()]
    ranged = df.repartitionByRange(*([] if parts is None else [parts]), *order)
    rows = written(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    # non-null surrogates of the keys: the join is a plain equality on the windows' partitioning
    group, surrogates = [], {}
    for c in by:
        surrogates[f"_s_{c}"] = F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
        surrogates[f"_z_{c}"] = F.col(c).isNull()
        group += [f"_s_{c}", f"_z_{c}"]
    here = Window.partitionBy(*group, "_part")
    in_order = here.orderBy(F.col(value).desc(), F.col(row_id).asc())
    by_value = here.orderBy(F.col(value).desc())
    local = rows.withColumns(surrogates).withColumns({
        "_rn": F.row_number().over(in_order),
        "_lag": F.lag(value).over(in_order), "_lead": F.lead(value).over(in_order),
    }).withColumns({"_rk": F.rank().over(by_value), "_dn": F.dense_rank().over(by_value)})

    summary = local.groupBy(*group, "_part").agg(
        F.max("_rn").cast("long").alias("_n"), F.max("_rk").cast("long").alias("_tail"), F.max("_dn").cast("long").alias("_d"),
        F.max(value).alias("_first"), F.when(F.count(value) == F.count(F.lit(1)), F.min(value)).alias("_last"))
    seq = Window.partitionBy(*group).orderBy("_part")
    ahead = seq.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumns({
        "_before": F.coalesce(F.sum("_n").over(ahead), F.lit(0)), "_dist": F.coalesce(F.sum("_d").over(ahead), F.lit(0)),
        "_prev": F.lag("_last").over(seq), "_has_prev": F.lag(F.lit(1)).over(seq).isNotNull(),
        "_next": F.lead("_first").over(seq), "_has_next": F.lead(F.lit(1)).over(seq).isNotNull(),
    })
    summary = summary.withColumn("_goes_on", F.col("_has_prev") & F.col("_first").eqNullSafe(F.col("_prev")))
    # where the last run of a range began; null if the whole range goes on a run
    began = F.when(~(F.col("_goes_on") & (F.col("_tail") == 1)), F.col("_before") + F.col("_tail"))
    summary = summary.withColumn("_began", began).withColumns({
        "_run": F.last("_began", ignorenulls=True).over(ahead),
        "_shared": F.sum(F.col("_goes_on").cast("long")).over(seq.rowsBetween(Window.unboundedPreceding, 0))})
    full = local.join(summary.select(*group, "_part", "_n", "_before", "_dist", "_shared", "_run", "_goes_on",
                                     "_prev", "_has_prev", "_next", "_has_next"), [*group, "_part"])

    columns = {
        "rank": F.when(F.col("_goes_on") & (F.col("_rk") == 1), F.col("_run")).otherwise(F.col("_before") + F.col("_rk")),
        "dense_rank": F.col("_dist") - F.col("_shared") + F.col("_dn"),
        "row_number": F.col("_before") + F.col("_rn"),
    }
    if unknown := [k for k in kinds.values() if k not in columns]:
        raise ValueError(f"unknown rank kind {unknown[0]!r}")
    out = {name: columns[kind].cast("long") for name, kind in kinds.items()}
    if lag_out:
        out[lag_out] = (F.when(F.col("_rn") > 1, F.col("_lag"))
                        .when(F.col("_has_prev"), F.col("_prev")).otherwise(F.lit(default)))
    if lead_out:
        out[lead_out] = (F.when(F.col("_rn") < F.col("_n"), F.col("_lead"))
                         .when(F.col("_has_next"), F.col("_next")).otherwise(F.lit(default)))
    return full.withColumns(out).select(*df.columns, *out)
