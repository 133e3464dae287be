"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.common import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that links reach, for every linked node.

    ``links`` holds (a, b) of longs, in any direction, repeats allowed; null
    ends are left out. Each round hangs every node's neighbours on its smallest
    one (first the larger neighbours, then the smaller ones), which halves
    long chains; a hot node's minimum is pre-aggregated per task. Rounds end
    when the links no longer change; each is written to the shared folder.
    """
    pairs = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .where("u <> v").distinct())
    pairs = materialize(pairs, "links")
    before = None
    for _ in range(max_rounds):
        # larger neighbours to the smallest of the closed neighbourhood
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = materialize(large, "links")
        # the node and its smaller neighbours to the smallest of them
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        pairs = materialize(small, "links")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components: links still change after {max_rounds} rounds")
