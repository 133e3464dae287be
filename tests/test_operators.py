"""Generic operators against brute force on random data with many ties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bancalyt.operators import (
    exclude,
    hot_keys,
    neighbor_diff,
    pivot_counts,
    rank_all,
    preaggregate_join,
    rank_within,
    salted_join,
    spread_join,
    top_k,
    top_n_per_group,
)
from conftest import collect


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([1, 2, 3, None]), rnd.choice([10, 20, 20, 30, None]))
            for i in range(300)]
    return spark.createDataFrame(rows, "id long, g long, v long")


@pytest.mark.parametrize("k", [0, 1, 7, 50, 400])
def test_rank_within_equals_full_window(data, k):
    got = rank_within(data, ["g"], [F.desc("v")], k, tie_break=["id"])
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    wn = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    full = data.select("*", F.rank().over(w).cast("long").alias("rnk"),
                       F.dense_rank().over(w).cast("long").alias("dense_rnk"),
                       F.row_number().over(wn).cast("long").alias("row_num"))
    want = full.orderBy(F.asc("g"), F.desc("v"), "id").limit(k)
    assert collect(got) == collect(want)


@pytest.mark.parametrize("direction,offset", [("lag", 1), ("lag", 2), ("lead", 1), ("lead", 3)])
def test_neighbor_diff_equals_full_window(data, direction, offset):
    k = 40
    got = neighbor_diff(data, ["g"], [F.desc("v")], "v", k, tie_break=["id"], offset=offset,
                        direction=direction, neighbor_out="nb", diff_out="d", decimals=None)
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    fn = F.lag if direction == "lag" else F.lead
    full = data.withColumn("nb", fn("v", offset).over(w)).withColumn("d", F.col("v") - F.col("nb"))
    want = full.orderBy(F.asc("g"), F.desc("v"), "id").limit(k)
    assert collect(got) == collect(want)


@pytest.mark.parametrize("method", ["rank", "dense_rank", "row_number"])
def test_top_n_per_group(data, method):
    got = top_n_per_group(data, ["g"], [F.desc("v")], 2, method, tie_break=["id"], out="r")
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    order = [F.desc("v"), F.asc("id")] if method == "row_number" else [F.desc("v")]
    w = Window.partitionBy("g").orderBy(*order)
    want = data.withColumn("r", fn().over(w).cast("long")).where("r <= 2")
    assert sorted(collect(got), key=repr) == sorted(collect(want), key=repr)


def test_top_k_is_deterministic(data):
    a = collect(top_k(data, [F.desc("v")], 10, ["id"]))
    b = collect(data.orderBy(F.desc("v"), "id").limit(10))
    assert a == b


def test_exclude_modes(spark, data):
    ex = spark.createDataFrame([(1,), (2,)], "g long")
    ex_null = spark.createDataFrame([(1,), (None,)], "g long")
    empty = spark.createDataFrame([], "g long")
    anti = exclude(data, ex, "g")
    assert sorted(collect(anti.select("g").distinct()), key=repr) == [(3,), (None,)]
    not_in = exclude(data, ex, "g", null_aware=True)
    assert collect(not_in.select("g").distinct()) == [(3,)]
    assert exclude(data, ex_null, "g", null_aware=True).count() == 0
    assert exclude(data, empty, "g", null_aware=True).count() == data.count()


def test_preaggregate_join_no_fan_out(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    fact = spark.createDataFrame([(1, 5), (1, 7), (3, 1)], "k long, v long")
    out = preaggregate_join(base, fact, "k", [F.count(F.lit(1)).alias("n")], fill={"n": 0})
    assert sorted(collect(out)) == [(1, "a", 2), (2, "b", 0)]


def test_pivot_counts_fixed_columns(spark):
    df = spark.createDataFrame([("x", "A", 2), ("x", "B", 1), ("y", "B", 4)],
                               "r string, c string, v long")
    out = pivot_counts(df, ["r"], "c", "v", ["A", "B", "C"]).orderBy("r")
    assert out.columns == ["r", "A", "B", "C"]
    assert collect(out) == [("x", 2, 1, 0), ("y", 0, 4, 0)]


def test_pivot_counts_other_column(spark):
    df = spark.createDataFrame([("x", "A", 2), ("x", "Z", 1), ("y", None, 4)], "r string, c string, v long")
    out = pivot_counts(df, ["r"], "c", "v", ["A"], other="rest").orderBy("r")
    assert out.columns == ["r", "A", "rest"]
    assert collect(out) == [("x", 2, 1), ("y", 0, 4)]


@pytest.mark.parametrize("salts", [1, 5])
def test_spread_join_equals_plain_join(spark, salts):
    fact = spark.createDataFrame([(i, "ab"[i % 2] if i % 7 else None) for i in range(60)], "id long, g string")
    means = spark.createDataFrame([("a", 1.0), (None, 2.0)], "g string, m double")
    got = spread_join(fact, means, "g", "id", salts)
    assert sorted(collect(got)) == sorted(collect(fact.join(means, "g")))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_task", [20, 3, 1000])
def test_salted_join_equals_plain_join(spark, how, rows_per_task):
    rnd = random.Random(3)
    # key 1 holds a third of the rows, key 2 a sixth; some null keys
    keys = [1] * 100 + [2] * 50 + [rnd.randint(3, 40) for _ in range(140)] + [None] * 10
    fact = spark.createDataFrame([(i, k, i * 7 % 13) for i, k in enumerate(keys)],
                                 "id long, k long, v long")
    per_key = spark.createDataFrame([(k, f"c{k}") for k in range(1, 41, 2)] + [(None, "n")],
                                    "k long, name string")
    hot = hot_keys(fact, "k", rows_per_task=rows_per_task)
    counts = {k: keys.count(k) for k in set(keys)}
    assert dict(collect(hot)) == {k: -(-n // rows_per_task) for k, n in counts.items() if k is not None and n > rows_per_task}
    got = salted_join(fact, per_key, "k", hot, salt_from="id", how=how)
    want = fact.join(per_key, "k", how)
    assert sorted(collect(got), key=repr) == sorted(collect(want), key=repr)
    assert "_salt" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [None, 1, 7, 40])
@pytest.mark.parametrize("ids", ["dense", "sparse"])
def test_rank_all_equals_full_window(spark, parts, ids):
    rnd = random.Random(parts)
    # value 20 holds more than a third of the rows; sparse ids are far apart
    rows = [(i * 3 + rnd.randint(0, 2) if ids == "dense" else i * 10**15 - 5 * 10**17, rnd.choice([1, 1, 1, 1, 2, 3, None]),
             rnd.choice([10, 20, 20, 20, 20, 20, 30, None, None, 40, 55, 7]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g long, v long")
    got = rank_all(df, ["g"], "v", "id", lag_out="lag", lead_out="lead", default=-1, parts=parts)
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    wn = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    want = df.select("*", F.rank().over(w).cast("long").alias("rnk"),
                     F.dense_rank().over(w).cast("long").alias("dense_rnk"),
                     F.row_number().over(wn).cast("long").alias("row_num"),
                     F.lag("v", 1, -1).over(wn).alias("lag"),
                     F.lead("v", 1, -1).over(wn).alias("lead"))
    assert (sorted(collect(got.select(*want.columns)), key=repr)
            == sorted(collect(want), key=repr))


def test_rank_all_splits_a_run_of_ties_and_shuffles_rows_once_after_the_ranges(spark):
    df = spark.range(9000).select("id", F.lit(1).alias("g"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    got = rank_all(df, ["g"], "v", "id", parts=12)
    tied = got.where("v = 5 and id % 3 = 0")
    assert tied.select("rnk").distinct().count() == 1 and tied.select("row_num").distinct().count() == 3000
    ranges = got.inputFiles()
    sizes = [spark.read.parquet(f).count() for f in ranges]
    assert len(sizes) == 12 and max(sizes) < 2 * 9000 / 12
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum(" Exchange " in line or "Exchange hash" in line for line in final.splitlines()) <= 6  # 7 with the one into ranges


def test_pivot_columns_come_from_the_data(spark):
    from bancalyt.operators import pivot_columns, pivot_counts
    rows = [("x", s, n + 1) for n, s in enumerate("abcdef")] + [("y", "f", 7), ("z", None, 2)]
    df = spark.createDataFrame(rows, "r string, s string, n long")
    out = pivot_counts(df, ["r"], "s", "n", None).orderBy("r")
    assert out.columns == ["r", *"abcdef"]
    assert collect(out) == [("x", 1, 2, 3, 4, 5, 6), ("y", 0, 0, 0, 0, 0, 7), ("z", 0, 0, 0, 0, 0, 0)]
    assert pivot_counts(df.limit(0), ["r"], "s", "n", None).collect() == []
    with pytest.raises(ValueError, match="more than 3"):
        pivot_columns(df, "s", limit=3)


def test_distinct_sketches_merge_within_their_bound(spark):
    from bancalyt.operators import distinct_sketches, error_bound, estimated, merged_sketches
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("c"), (F.col("id") % 7).alias("b"), (F.col("id") % 2).alias("p"))
    fine = distinct_sketches(df, ["b", "p"], "c")
    for keys in (["b"], ["p"], []):
        exact = df.groupBy(*keys).agg(F.count_distinct("c").alias("n"))
        got = merged_sketches(fine, keys).withColumn("e", estimated())
        pairs = exact.join(got, keys) if keys else exact.crossJoin(got)
        assert all(abs(r.e - r.n) <= error_bound() * r.n for r in pairs.collect())
