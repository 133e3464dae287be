"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bancalyt.llm import components, simhash
import brute


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", ["", " \n", "A", "a b c", "A b c d", "A  b\tc\nd É e f", "x y z w v u É k " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == signed(brute.simhash(text))


def test_fingerprint_of_a_long_text_is_summed_in_pieces():
    text = " ".join(f"w{i * i % 977}" for i in range(70_000))
    assert simhash.fingerprint(text.encode()) == signed(brute.simhash(text))


def test_every_near_pair_meets_at_a_home_anchor(spark):
    pick = random.Random(2)
    base = [pick.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << i for i in pick.sample(range(64), pick.randint(1, 4))) for b in base]
    fps = spark.createDataFrame([(signed(x),) for x in {*base, *near}], "fp long")
    rows = simhash.anchored(fps).toPandas()
    assert rows[rows.home == 1].groupby("fp").size().eq(2).all()
    homes = rows[rows.home == 1].merge(rows, on="anchor")
    met = set(zip(homes.fp_x, homes.fp_y, strict=True))
    assert all((signed(a), signed(b)) in met or (signed(b), signed(a)) in met for a, b in zip(base, near, strict=True))


@pytest.mark.parametrize("block", [1 << 15, 2])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "HOME_BLOCK", block)
    pick = random.Random(4)
    base = [pick.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << i for i in pick.sample(range(64), pick.randint(0, 9))) for b in base for _ in range(25)}
    rows = [signed(x) for x in sorted(fps)]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in rows], "fp long"))
    found = {r.node: r.root for r in components.components(links).collect()}
    want = brute.components([x & (2**64 - 1) for x in rows], rows, 4)
    assert [found.get(x, x) for x in rows] == want


@pytest.mark.parametrize("count", [2, 40, 3000])
def test_forest_joins_what_all_pairs_join(count):
    pick = np.random.default_rng(count)
    base = pick.integers(-2**63, 2**63, 3, dtype=np.int64)
    flips = np.int64(1) << pick.integers(0, 63, (count, 3), dtype=np.int64)
    fps = np.unique(base[pick.integers(0, 3, count)] ^ np.bitwise_xor.reduce(flips, axis=1) ^ np.where(pick.random(count) < 0.3, np.int64(-2**63), 0))
    links = simhash._forest(fps[::2], fps, 4)
    assert len(links) < len(fps)
    label = {x: x for x in fps.tolist()}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= 4
        label[root(a)] = root(b)
    near = simhash._near(fps[::2], fps, 4)
    for i, f in enumerate(fps[::2].tolist()):
        assert {root(x) for x in fps[near[i]].tolist()} == {root(f)}


def test_long_chain_of_links(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in components.components(links).collect()} == {(i, 0) for i in range(301)}


def test_no_links(spark):
    assert components.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).collect() == []


ROWS = [(3, "a b c d e"), (1, "A B c d e"), (None, "a b c d e"), (2, None), (9, ""), (4, "quite another text of words here"),
        (4, "quite another text of words here"), (None, "only this row has no id and no partner at all")]


def test_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = simhash.simhash_components(docs).select("doc_id", "fp", "component_id").collect()
    fps = [brute.simhash(t) for _, t in ROWS]
    want = brute.components(fps, [i for i, _ in ROWS], 4)
    assert brute.rows_by(got) == brute.rows_by(zip([i for i, _ in ROWS], map(signed, fps), want, strict=True))


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(0))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert brute.rows_by((r.doc_id, r.text) for r in kept.collect()) == brute.rows_by(
        [(1, "A B c d e"), (2, None), (4, "quite another text of words here"), (None, ROWS[-1][1])])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(docs).collect() == [] and simhash.keep_one(docs).collect() == []


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.simhash_components(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    fps = [brute.simhash(r.text) for r in rows]
    want = brute.components(fps, [r.doc_id for r in rows], 4)
    assert got == {r.doc_id: (signed(f), c) for r, f, c in zip(rows, fps, want, strict=True)}


def test_more_bits_than_covered(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([], "fp long"), 5)


def test_patterns_reach_every_anchor_in_reach():
    rows = np.array(simhash._patterns())
    for half, reach in ((0, 3), (1, 2)):
        mine = rows[rows[:, 0] == half]
        assert mine[mine[:, 2] == 1][:, 1].tolist().__len__() == 32  # one home per syndrome
        assert {bin(f).count("1") for f in mine[:, 3].tolist()} == set(range(reach + 1))


def test_kept_rows_with_columns_of_any_name(spark):
    rows = [(1, "a b c d e", 77, 5), (1, "a b c d e", 77, 4), (2, "a b c d e", 78, 1), (None, "a b c d e", 79, 1), (3, "q r s t u v w", 80, 1), (3, "q r s t u v w", 80, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int, _k long")
    for parts in (1, 3):
        got = sorted(map(tuple, simhash.keep_one(docs.repartition(parts)).collect()))
        assert [r[:3] for r in got] == [(1, "a b c d e", 77), (3, "q r s t u v w", 80)]
        assert got == sorted(map(tuple, simhash.keep_one(docs.orderBy("_k")).collect()))
