"""Suffix-array dedup and repeated-phrase automata against brute force."""

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from bancalyt.llm import phrases, suffixes
from bancalyt.llm.rolling import BYTE_VALUES, Prefix

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows():
    return brute.shared_passages()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_strings(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "removed_spans", lambda docs, f=suffixes.removed_spans: f(docs, hot))
    assert brute.rows_by(suffixes.report(frame(spark, rows)).collect()) == brute.without_strings(rows, 400)


def test_strings_in_many_small_ranges_and_runs(spark, rows, monkeypatch):
    for name, value in (("RANGE", 40), ("RUN", 30), ("SAMPLE", 2), ("COPIES", 2), ("BLOCK_BYTES", 700)):
        monkeypatch.setattr(suffixes, name, value)
    assert brute.rows_by(suffixes.report(frame(spark, rows)).collect()) == brute.without_strings(rows, 400)


def common_phrase(pick) -> str:
    """A phrase of 40 bytes whose first 16 have a low hash: wherever it stands, it is the anchor."""
    data = pick.integers(97, 123, 2_000_000).astype(np.uint8)
    at = int(Prefix(BYTE_VALUES[data]).grams(suffixes.GRAM)[:-40].argmin())
    return bytes(data[at:at + 40]).decode()


# many small keys behind one phrase; and few keys with many occurrences each
@pytest.mark.parametrize(("keys", "copies", "one_in", "average", "bound"), [(200, 3, 2, 30, 150), (40, 30, 16, 100, 350)])
def test_ranges_part_between_keys(spark, monkeypatch, keys, copies, one_in, average, bound):
    pick = np.random.default_rng(11)
    letters = lambda n: bytes(pick.integers(97, 123, n).tolist()).decode()
    phrase, tails = common_phrase(pick), [letters(500) for _ in range(keys)]
    rows = [(i, letters(300) + phrase + tails[i % keys]) for i in range(keys * copies)]
    spans = suffixes._spans

    def bounded(runs, window):
        size = sum(r.size for r in runs)
        if size > bound:
            raise ValueError(f"a range of {size} suffixes")
        return spans(runs, window)

    for name, value in (("_spans", bounded), ("RANGE", average), ("RUN", 200), ("SAMPLE", one_in)):
        monkeypatch.setattr(suffixes, name, value)
    assert brute.rows_by(suffixes.report(frame(spark, rows)).collect()) == brute.without_strings(rows, 400)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_phrases(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(phrases, "removed_spans", lambda docs, f=phrases.removed_spans: f(docs, hot))
    assert brute.rows_by(phrases.report(frame(spark, rows)).collect()) == brute.without_phrases(rows, 35)


def test_phrases_in_many_small_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD", 20)
    assert brute.rows_by(phrases.report(frame(spark, rows)).collect()) == brute.without_phrases(rows, 35)


def test_phrases_match_sql(spark, rows):
    docs = frame(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert brute.rows_by(con.execute(phrases.oracle("documents")).fetchall()) == brute.without_phrases(rows, 35)


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert brute.rows_by(suffixes.report(docs).collect()) == brute.without_strings(rows, 400)
    assert brute.rows_by(phrases.report(docs).collect()) == brute.without_phrases(rows, 35)


@pytest.mark.parametrize("module", [suffixes, phrases])
def test_empty_table(spark, module):
    assert module.report(frame(spark, [])).collect() == []


@pytest.mark.parametrize("module", [suffixes, phrases])
def test_texts_keep_other_columns(spark, rows, module):
    docs = frame(spark, rows).withColumn("spans", F.lit("x")).withColumn("dk", F.lit(1)).withColumn("key", F.lit(None).cast("int"))
    out = module.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = {r.doc_id: r.text for r in out.where("doc_id is not null").collect()}
    assert got[500] is None and got[501] == "" and got[503] == ("" if module is suffixes else "x" * 1300)


def test_merge_is_sorted_with_exact_shared_lengths():
    pick = np.random.default_rng(3)
    runs, everything = [], []
    for _ in range(7):
        strings = sorted(bytes(pick.integers(97, 99, pick.integers(0, 12)).tolist()) for _ in range(pick.integers(1, 60)))
        everything += strings
        runs.append(suffixes.Run(suffixes.Run.pack([(s, b"", 0, 0, 0, 0, 0) for s in strings])))
    found = list(suffixes.merge(runs))
    merged = [runs[r].suffixes[i] for r, i, _ in found]
    assert merged == sorted(everything)
    for before, after, (_, _, lcp) in zip([b"", *merged], merged, found, strict=False):
        assert lcp == suffixes.shared(before, after, 0)


def test_merge_of_nothing_and_of_one():
    assert list(suffixes.merge([suffixes.Run(suffixes.Run.pack([]))])) == []
    one = suffixes.Run(suffixes.Run.pack([(b"a", b"", 0, 0, 0, 0, 0), (b"ab", b"", 0, 0, 0, 0, 0)]))
    assert list(suffixes.merge([one])) == [(0, 0, 0), (0, 1, 1)]


@pytest.mark.parametrize("window", [50, 200, 333])
def test_strings_of_other_lengths(spark, rows, window):
    rows = [r for r in rows if r[0] is not None and r[0] < 60] + [(503, "x" * 1300), (None, rows[0][1])]
    spans = suffixes.removed_spans(frame(spark, rows), window=window).collect()
    whole = brute.without_strings(rows, window)
    removed = sum(r[2] for r in set(whole))  # spans of equal rows stand once
    covered = 0
    for r in spans:
        covered += len(set().union(*(range(s.begin, s.end) for s in r.spans)))
    assert covered == removed
    kept = suffixes.without_repeats(frame(spark, rows), window).collect()
    assert sum(len((r.text or "").encode()) for r in kept) <= sum(len((t or "").encode()) for _, t in rows) - sum(r[2] for r in whole)


@pytest.mark.parametrize("cut", [suffixes.without_repeats, phrases.without_repeats])
def test_columns_of_any_name_stay(spark, rows, cut):
    names = ["_spans", "_s", "dk", "dk2", "spans", "key", "_c0", "_SPANS_"]
    extra = frame(spark, rows).select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    got = cut(extra)
    assert got.columns == ["doc_id", "text", *names]
    found = got.collect()
    assert len(found) == len(rows) and all(tuple(r)[2:] == tuple(range(len(names))) for r in found)
    assert brute.rows_by((r.doc_id, r.text) for r in found) == brute.rows_by(map(tuple, cut(frame(spark, rows)).collect()))
