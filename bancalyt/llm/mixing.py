"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key; within its source documents stand in
key order, cut into key ranges (the leading hex digits), so that prefix sums
are those of the ranges before plus those within the range and no task holds
a source. A source's budget is met by whole epochs and one last epoch that
is cut where the prefix sum reaches what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bancalyt.llm.common import WORD, materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: hex digits of a key that name its range: 4096 ranges a source
RANGE_DIGITS = 3


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with _size (words of the text; null: 0), _key (random by hash of id
    and size) and _tie (a hash of the text, by which equal keys are put in order, so
    that reruns agree)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumn("_size", size).withColumn(
        "_key", F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string"), F.col("_size").cast("string")))).withColumn(
        "_tie", F.xxhash64("text"))


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    The sum of all sizes is shared by weight; a target stops at ``max_epochs``
    times its source's size and the rest is shared anew, until none is above.
    That is one common rate r with target = min(weight * r, cap): the sources
    are put in the order of cap / weight, and r follows from the prefix sums at
    the first source that r leaves below its cap. One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).cast("long")
    rows = sources.select("source", "source_size", weight.alias("weight"))
    rows = rows.withColumn("cap", F.col("source_size") * max_epochs)
    order = [F.col("cap").cast("double") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("*", F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"),
                       F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("gone"),
                       F.sum("source_size").over(everything).alias("total"), F.sum("weight").over(everything).alias("weights"))
    rate = (F.col("total") - F.col("capped")).cast("double") / (F.col("weights") - F.col("gone"))
    rows = rows.withColumn("rate", rate).withColumn("open", F.col("rate") * F.col("weight") < F.col("cap"))
    rows = rows.withColumn("r", F.min(F.when(F.col("open"), F.struct(F.col("cap").cast("double") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("rate")))).over(everything)["rate"])
    target = F.when(F.col("r").isNull() | (F.col("weight") * F.col("r") >= F.col("cap")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("r"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows of ``sized`` with _source_size, _target and _copies (0 to
    ``max_epochs``): how often the mix takes the document.

    In the last, partial epoch a document is taken if at most half of it lies
    beyond the budget, so a source ends within half a document of its target.
    Null sources are one source of their own, the last; wordless documents are
    as free as their size and follow the epochs; rows of equal keys (equal in id
    and size) stand by a hash of their texts."""
    # non-null names of source and range: windows and join share one shuffle of the rows
    place = ["_source", "_no_source", "_range"]
    rows = rows.withColumns({"_source": F.coalesce(F.col("source").cast("string"), F.lit("")), "_no_source": F.col("source").isNull(),
                             "_range": F.substring("_key", 1, RANGE_DIGITS)})
    ranges = materialize(rows.groupBy("source", *place).agg(F.sum("_size").alias("words")), "mix-ranges")
    totals = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(totals, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", F.least(epochs, F.lit(max_epochs))).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    ahead = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("s"), *place, F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("_ahead"))
    plan = plan.select(F.col("source").alias("s2"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "epochs", "rest")
    ranges = materialize(ranges.join(plan, F.col("s").eqNullSafe(F.col("s2"))).drop("s", "s2"), "mix-plan")
    within = Window.partitionBy(*place).orderBy("_key", "_size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_within", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    middle = F.col("_ahead") + F.col("_within") + F.col("_size") / F.lit(2.0)
    copies = (F.col("epochs") + F.when((F.col("rest") > 0) & (middle <= F.col("rest")), 1).otherwise(0)).cast("int")
    return (placed.join(ranges, place).withColumn("_copies", copies)
            .drop(*place, "_ahead", "_within", "epochs", "rest"))


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    rows = materialize(sized(docs.select("doc_id", "source", "text")).drop("text"), "mix-sizes")
    return mix(rows).select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                            F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with its
    columns of any name."""
    held = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row"))
    rows = mix(sized(held).drop("text")).where("_copies > 0")
    return rows.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


ORACLE = """
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM {documents}
), keyed AS (
  SELECT *, md5(concat_ws(':', 'mix-1', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))) AS k FROM docs
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w
  FROM docs GROUP BY source
), rated AS (
  SELECT a.source, a.source_size, a.cap, a.w,
    CAST((SELECT sum(source_size) FROM src) - coalesce((SELECT sum(b.cap) FROM src b WHERE b.cap / CAST(b.w AS DOUBLE) < a.cap / CAST(a.w AS DOUBLE)), 0) AS DOUBLE)
      / CAST((SELECT sum(b.w) FROM src b WHERE b.cap / CAST(b.w AS DOUBLE) >= a.cap / CAST(a.w AS DOUBLE)) AS DOUBLE) AS rate
  FROM src a
), r AS (
  SELECT arg_min(rate, cap / CAST(w AS DOUBLE)) AS r FROM rated WHERE rate * w < cap
), goal AS (
  SELECT source, source_size, CASE WHEN r IS NULL OR w * r >= cap THEN CAST(cap AS DOUBLE) ELSE w * r END AS target FROM rated, r
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS epochs FROM goal
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS UNBOUNDED PRECEDING) - size AS ahead FROM keyed
)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN target - epochs * source_size > 0 AND ahead + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed JOIN plan ON placed.source IS NOT DISTINCT FROM plan.source
"""
