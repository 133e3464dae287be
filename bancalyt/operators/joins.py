"""Join-shaped operators: exclusion, pre-aggregated enrichment, joins on
hot keys and on keys of few values.

Broadcast policy: none of these hints a broadcast.  The small sides here
(per-key aggregates, exclusion sets, hot keys) have no size bound that
holds at every scale, so the decision is left to adaptive execution, which
turns a sort-merge join into a broadcast join only after it has measured
the shuffled side at run time (``spark.sql.adaptive.autoBroadcastJoinThreshold``)
and otherwise keeps the shuffle join, with skew-join splitting of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude(df: DataFrame, excl: DataFrame, on: str, null_aware: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``on`` key is not in ``excl``.

    ``null_aware=False``: anti join (``NOT EXISTS``); a null in ``excl``
    matches nothing.  ``null_aware=True``: SQL ``NOT IN`` semantics: an empty
    set keeps every row; a null in the set removes every row; a null probe
    key is removed whenever the set is not empty.

    The null-aware form is written as a plain hash anti join plus one scalar
    aggregate over the set, instead of Spark's own ``NOT IN`` plan, which
    needs the whole set broadcast (or falls back to a nested-loop join).
    Anti joins only test existence, so a hot key in ``excl`` costs one
    buffered row per key in the sort-merge join.
    """
    # No distinct() on the set: duplicates do not change an anti join, and
    # an aggregate between the join and its shuffle stage would keep
    # adaptive execution from splitting a hot key's partition on the left.
    keys = excl.select(on)
    if not null_aware:
        return df.join(keys, on, "left_anti")
    # 0: empty set, 1: non-empty without nulls, 2: contains a null
    state = keys.agg(
        F.when(F.count_if(F.col(on).isNull()) > 0, F.lit(2))
         .when(F.count(F.lit(1)) > 0, F.lit(1))
         .otherwise(F.lit(0))
    ).scalar()
    kept = df.join(keys.where(F.col(on).isNotNull()), on, "left_anti")
    # one reference to the scalar: [empty -> keep, no null -> keep non-null
    # keys, has null -> drop][state]
    verdict = F.element_at(F.array(F.lit(True), F.col(on).isNotNull(), F.lit(False)), state + 1)
    return kept.where(verdict)


def preaggregate_join(base: DataFrame, fact: DataFrame, on: str | Sequence[str],
                      aggs: Sequence[Column], how: str = "left",
                      fill: Mapping[str, object] | None = None) -> DataFrame:
    """Aggregate ``fact`` per join key first, then join the one-row-per-key
    result to ``base``.

    The aggregate and the join share the same hash partitioning on the key,
    so this costs no extra shuffle, it cannot fan ``base`` rows out, and the
    partial aggregation shrinks hot keys before the exchange.
    """
    keys = [on] if isinstance(on, str) else list(on)
    agg = fact.groupBy(*keys).agg(*aggs)
    joined = base.join(agg, keys, how)
    return joined.na.fill(dict(fill)) if fill else joined


#: hot keys that a sketch reports at most, and the keys that it counts at a time
HOT_KEYS = 1_000
TRACKED = 100_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """``(key, _salts)``: keys holding more than ``rows_per_task`` rows of ``df`` and
    the number of tasks their rows need, ``ceil(rows / rows_per_task)``.

    A frequent-items sketch, merged from one per task: no key is shuffled, and
    there are at most ``HOT_KEYS`` rows, the most frequent keys.  Its counts err
    by less than ``4 x rows / TRACKED`` (exact up to some ``TRACKED`` different keys);
    they only choose the number of salts, never the result of a join."""
    sketch = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED})").alias("_top"))
    return (sketch.select(F.explode("_top").alias("_t"))
            .where(F.col("_t.count") > rows_per_task)
            .select(F.col("_t.item").alias(key), F.ceil(F.col("_t.count") / rows_per_task).cast("long").alias("_salts")))


def salted_join(fact: DataFrame, per_key: DataFrame, key: str, hot: DataFrame, salt_from: str,
                how: str = "inner") -> DataFrame:
    """``fact JOIN per_key ON key`` with the rows of hot keys spread over
    several tasks.

    ``per_key`` has at most one row per key (customers, a key set for a
    semi/anti join); ``hot`` is ``(key, _salts)`` from :func:`hot_keys`, at most
    ``HOT_KEYS`` rows, which reach all tasks as one map (a scalar subquery).  So
    the rows of ``fact`` are shuffled once, on (key, salt).  A row with a hot key
    gets salt ``hash(salt_from) mod _salts`` (deterministic, so a recomputed
    task assigns the same salt) and the matching ``per_key`` row is replicated
    once per salt.  Every other row joins with salt 0 like an ordinary hash
    join, whose large partitions adaptive execution splits.  Works for inner,
    left, left_semi and left_anti joins.
    """
    salts = hot.agg(F.map_from_entries(F.collect_list(F.struct(key, "_salts")))).scalar()
    many = F.coalesce(F.try_element_at(salts, F.col(key)), F.lit(1).cast("long"))
    own = F.xxhash64(salt_from)
    # rows without a key meet nothing: any salt will do, and spreads them
    salted_fact = fact.withColumn("_salt", F.when(F.col(key).isNull(), own).otherwise(F.pmod(own, many)))
    replicated = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
    return salted_fact.join(replicated, [key, "_salt"], how).drop("_salt")


def spread_join(fact: DataFrame, per_group: DataFrame, key: str, salt_from: str,
                salts: int | None = None) -> DataFrame:
    """Inner join on a key of few values (segment, risk level): every row of
    ``per_group`` (one per value) is replicated ``salts`` times (default: the
    session's number of shuffle partitions) and the rows of ``fact`` are dealt
    over the copies, so that no value's rows meet in one task even where the
    small side is not broadcast."""
    salts = salts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = per_group.withColumn("_salt", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    dealt = fact.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")
