"""Nearest neighbours against brute force, and the pipeline against plain stages."""

import random
import re

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from bancalyt.llm import ann_tree, bpe, mixing, quality, queries

SF = "/root/testdata/sf0.001"


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("item", F.lit("x")).withColumn("leaf", F.lit(1))


def test_small_table_is_searched_whole(spark):
    pick = np.random.default_rng(1)
    nan, inf = float("nan"), float("inf")
    rows = [(i, pick.normal(size=4).tolist()) for i in range(30)]
    rows += [(40, None), (60, [0.0] * 4), (80, [1.0, nan, 0.0, 0.0]), (100, [1.0, None, 0.0, 0.0]), (120, [inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (0, rows[0][1])]
    rows += [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]  # equal vectors: ties go to the smaller id
    got, want = found(ann_tree.neighbours(vectors(spark, rows), lambda c: c % 20 == 0).collect()), brute.nearest({r[0]: r for r in rows if r[0] is not None}.values(), 20, 20)
    assert {q: [i for i, _ in near] for q, near in got.items()} == {q: [i for i, _ in near] for q, near in want.items()}
    for q in want:
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


@pytest.mark.parametrize("task_items", [1 << 13, 40])
def test_distinct_vectors_that_tie(spark, monkeypatch, task_items):
    monkeypatch.setattr(ann_tree, "TASK_ITEMS", task_items)
    monkeypatch.setattr(ann_tree, "LEAF", 500)  # one leaf: searched whole
    every = [[float(x // 3 ** i % 3 - 1) for i in range(5)] for x in range(3 ** 5) if x != 121]
    ids = np.random.default_rng(5).permutation(len(every)).tolist()
    rows = list(zip(ids, every, strict=True))
    got, want = found(ann_tree.neighbours(vectors(spark, rows), lambda c: c % 20 == 0).collect()), brute.nearest(rows, 20, 20)
    assert got == want


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0, 2.0])]])
def test_nothing_to_find(spark, rows):
    assert ann_tree.neighbours(vectors(spark, rows), lambda c: c % 20 == 0).collect() == []


def test_leaves_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "TASK_ITEMS", 7)
    monkeypatch.setattr(ann_tree, "TASK_QUERIES", 3)
    monkeypatch.setattr(ann_tree, "SAMPLE", 40)
    monkeypatch.setattr(ann_tree, "LEAF", 10)
    monkeypatch.setattr(ann_tree, "TARGET_RECALL", 1.0)
    pick = np.random.default_rng(2)
    rows = [(i, pick.normal(size=3).tolist()) for i in range(200)]
    got, want = found(ann_tree.neighbours(vectors(spark, rows), lambda c: c % 20 == 0).collect()), brute.nearest(rows, 20, 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in got) and hits >= 0.9 * 20 * len(want)


def test_a_hot_group_is_dealt_by_its_own_counts(spark, monkeypatch):
    """A third of the vectors in one group: no task has much over TASK_ITEMS vectors or
    TASK_QUERIES queries, other groups are not repeated, and each pair meets once."""
    monkeypatch.setattr(ann_tree, "TASK_ITEMS", 100)
    monkeypatch.setattr(ann_tree, "TASK_QUERIES", 50)
    filed = spark.range(3000).select(F.col("id").alias("item"), F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 40).cast("long").alias("grp"))
    probes = spark.range(400).select(F.col("id").alias("q"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 60).cast("long").alias("grp"))
    left, right = ann_tree.deal(filed, probes)
    keys = ["grp", "part", "qpart"]
    items, asked = ({tuple(r)[:3]: r["count"] for r in x.groupBy(*keys).count().collect()} for x in (left, right))
    assert len({k for k in items if k[0] == 0}) == 10 * 4 and max(items.values()) < 150 and max(asked.values()) < 80
    assert {k[1:] for k in items if k[0]} == {(0, 0)} and sum(n for k, n in items.items() if k[0]) == 2000
    pairs = right.join(left, keys).select("q", "item")
    assert pairs.count() == pairs.distinct().count() == probes.join(filed, "grp").count()


def test_recall_with_a_sample_far_below_the_table(spark, monkeypatch):
    """At the production target, with a twentieth of the vectors in the sample."""
    monkeypatch.setattr(ann_tree, "SAMPLE", 400)
    monkeypatch.setattr(ann_tree, "LEAF", 16)
    pick = np.random.default_rng(8)
    centres = pick.normal(size=(60, 16)) * 2
    rows = [(i, (centres[pick.integers(60)] + pick.normal(size=16)).tolist()) for i in range(8000)]
    got = found(ann_tree.neighbours(vectors(spark, rows), lambda c: c % 100 == 0).collect())
    every = np.array([v for _, v in rows])
    hits = 0
    for q, near in got.items():
        score = every @ every[q]
        score[q] = -np.inf
        hits += len({i for i, _ in near} & set(np.argsort(-score)[:20].tolist()))
    assert len(got) == 80 and hits >= 0.9 * 20 * len(got)


def test_recall_on_the_test_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got, want = found(queries.op2_ann_tree(spark, "/root/testdata/sf0.1").collect()), brute.nearest(rows, 20, 20)
    assert set(got) == set(want) and all(len(near) == 20 for near in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def plain_stages(docs):
    """Rows (doc_id, ids) of the pipeline, by brute force; docs: list of dicts."""
    verdict = {i: k for i, k in enumerate(quality.measure([(d["text"] or "").encode() for d in docs])["kept"].tolist())}
    docs = [d for i, d in enumerate(docs) if verdict[i]]
    near = brute.components([brute.simhash(d["text"]) for d in docs], [d["doc_id"] for d in docs], 4)
    first = {}
    for d, c in zip(docs, near, strict=True):
        if c not in first or d["doc_id"] < first[c]["doc_id"]:
            first[c] = d
    docs = list(first.values())
    data, size = [d["text"].encode() for d in docs], corpus_pipeline.PASSAGE
    seen = {}
    for t in data:
        for i in range(len(t) - size + 1):
            seen[t[i:i + size]] = seen.get(t[i:i + size], 0) + 1
    kept = []
    for d, t in zip(docs, data, strict=True):
        mask = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                mask[i:i + size] = b"\1" * size
        kept.append({**d, "text": bytes(b for b, m in zip(t, mask, strict=True) if not m).decode("utf-8", "ignore")})
    con = duckdb.connect()
    import pyarrow as pa

    con.register("documents", pa.Table.from_pylist(kept))
    taken = {r[0]: r[4] for r in con.execute(mixing.ORACLE.format(documents="documents")).fetchall()}
    own, out = bpe.load(bpe.TOKENIZER), []
    for d in kept:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", d["text"]))
        out += [(d["doc_id"], own.encode(d["text"]))] * (taken[d["doc_id"]] // size if size else 0)
    return sorted(out)


def test_pipeline_equals_plain_stages(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = corpus_pipeline.run(spark, SF)
    words = got.where("n_tokens > 0").select("doc_id", "ids").collect()
    assert sorted((r.doc_id, r.ids) for r in words) == [r for r in plain_stages(rows) if r[1]]


def test_stages_on_odd_rows(spark):
    pick = random.Random(3)
    text = " ".join(pick.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(pick.randint(0, 99)) for _ in range(80))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, text + " end", None, None, None), (2, None, "en", "s", 0), (3, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        whole, none = stage(spark, docs, SF), stage(spark, docs.limit(0), SF)
        whole.collect()
        assert none.collect() == []
        if name != corpus_pipeline.STAGES[-1][0]:
            assert whole.columns == docs.columns


def test_registered_queries():
    names = entry.queries()
    assert [n for n in (*queries.QUERIES, "pipeline") if n not in names] == []
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(names)
