"""Removing passages of words that recur, located by repeated-phrase automata.

Windows of 35 words that may recur are found by their anchors (``anchors``).
The stretches around anchors with one key are brought to one shard, where
recurring passages are confirmed and compiled into an Aho-Corasick automaton
over word numbers; all stretches of the shard, which together are all places
of all documents where its passages can stand, are streamed through it to
locate every occurrence.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.anchors import HOT, Sieve, counted_windows, keyed, recurring, with_spans
from bancalyt.llm.common import as_bytes, blocks, free_name, materialize, release_memory, workers_find_package
from bancalyt.llm.rolling import Prefix, mix, window_anchors, words_of

WINDOW = 35
#: first words of a window among which its anchor is chosen
WIDTH = 24
#: words whose hash orders the places
GRAM = 4
#: stretches that one automaton is built for (a key's stretches stay together)
SHARD = 10_000


class Anchored:
    """Anchors of the word windows of some texts: arrays ``text``, ``at``,
    ``first``, ``last`` (word numbers in the text) and ``key``."""

    def __init__(self, texts: list[bytes]):
        _, _, self.hashes, owner, self.base = words_of(texts)
        prefix = Prefix(self.hashes)
        n = len(self.hashes)
        starts = np.flatnonzero(owner[:max(0, n - WINDOW + 1)] == owner[WINDOW - 1:]) if n >= WINDOW else np.zeros(0, np.int64)
        at, first, last = window_anchors(prefix.grams(GRAM), starts, WIDTH)
        self.text = owner[at]
        move = self.base[self.text]
        self.key = prefix.hashes(at, at + WINDOW - WIDTH + 1).view(np.int64)
        self.at, self.first, self.last = at - move, first - move, last - move


def passages(numbers: list[np.ndarray], weights: np.ndarray) -> set[tuple[int, ...]]:
    """The recurring passages of some stretches of word numbers: each longest
    run of windows of which every one stands in two places or more."""
    begin = np.cumsum([0, *map(len, numbers)])
    joined = np.concatenate(numbers).astype(np.uint64)
    windows = Prefix(mix(joined + np.uint64(1))).grams(WINDOW)
    owner = np.repeat(np.arange(len(numbers)), np.diff(begin))
    whole = np.flatnonzero(owner[:len(windows)] == owner[WINDOW - 1:])
    _, which = np.unique(windows[whole], return_inverse=True)
    again = np.bincount(which, weights[owner[whole]])[which] > 1
    hit = whole[again]
    if not len(hit):
        return set()
    cut = np.flatnonzero((hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])) + 1
    starts, stops = hit[np.concatenate([[0], cut])], hit[np.append(cut, len(hit)) - 1] + WINDOW
    return {tuple(joined[a:b].tolist()) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)}


def locate(found: set[tuple[int, ...]], numbers: list[np.ndarray]) -> list[list[tuple[int, int]]]:
    """Per stretch the (begin, end) of the words covered by the passages."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for passage in found:
        automaton.add_word(passage)
    automaton.make_automaton()
    out = []
    for stretch in numbers:
        spans: list[tuple[int, int]] = []
        for end, length in automaton.iter(tuple(stretch.tolist())):
            begin = end + 1 - length
            while spans and spans[-1][1] >= begin:  # ends ascend
                begin = min(begin, spans.pop()[0])
            spans.append((begin, end + 1))
        out.append(spans)
    return out


def _shard_spans(stretches: list[bytes]) -> list[list[tuple[int, int]]]:
    """The covered words of each stretch of one shard; equal ones are done once."""
    distinct: dict[bytes, int] = {}
    which = [distinct.setdefault(s, len(distinct)) for s in stretches]
    vocabulary: dict[bytes, int] = {}
    numbers = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in s.split(b" ")], np.int64) for s in distinct]
    found = passages(numbers, np.bincount(which))
    if not found:
        return [[] for _ in stretches]
    spans = locate(found, numbers)
    return [spans[i] for i in which]


def removed_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(dk, dk2, spans): per row key of ``anchors.keyed`` the array of (begin,
    end) word numbers to remove, in any order, maybe overlapping."""
    workers_find_package(docs.sparkSession)
    rows = keyed(docs)

    def list_anchors(batches):
        for batch in blocks(batches, "text"):
            found = Anchored(as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(found.key), batch.column("dk").take(pa.array(found.text)), pa.array(found.at)], ["key", "dk", "at"])

    listed = materialize(rows.select("text", "dk").mapInArrow(list_anchors, "key long, dk long, at long"), "word-anchors")
    again = recurring(listed, hot)
    candidates = Sieve(again.places).split(rows, True).join(again.places, "dk")

    def marked(batch, column):
        texts = as_bytes(batch.column("text"))
        found = Anchored(texts)
        lists = batch.column(column)
        offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
        pairs = np.repeat(np.arange(len(texts)), np.diff(offsets)) << 40 | values[offsets[0]:offsets[-1]]
        return texts, found, np.isin(found.text << 40 | found.at, pairs)

    def cut_stretches(batches):
        for batch in blocks(batches, "text"):
            texts, found, wanted = marked(batch, "cold")
            own, words, out = -1, [], []
            for t, first, last in zip(*(x[wanted].tolist() for x in (found.text, found.first, found.last)), strict=True):
                if t != own:
                    own, words = t, texts[t].split()
                out.append(b" ".join(words[first:last + WINDOW]))
            of = pa.array(found.text[wanted])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.key[wanted]), pa.array(out, pa.binary()), batch.column("dk").take(of), batch.column("dk2").take(of), pa.array(found.first[wanted])],
                ["key", "stretch", "dk", "dk2", "first"])

    def run_shards(batches):
        held: list[tuple] = []  # key, stretch, dk, dk2, first

        def flush(until):
            spans = _shard_spans([h[1] for h in held[:until]])
            out = [(h[2], h[3], h[4] + a, h[4] + b) for h, found in zip(held, spans, strict=False) for a, b in found]
            del held[:until]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            release_memory()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["dk", "dk2", "begin", "end"])

        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            while len(held) > SHARD:
                until = SHARD
                while until < len(held) and held[until][0] == held[until - 1][0]:
                    until += 1
                if until == len(held):  # the last key may go on
                    break
                yield flush(until)
        if held:
            yield flush(len(held))

    spans = (candidates.where(F.size("cold") > 0).select("text", "dk", "dk2", "cold")
             .mapInArrow(cut_stretches, "key long, stretch binary, dk long, dk2 long, first long")
             .repartition("key").sortWithinPartitions("key").mapInArrow(run_shards, "dk long, dk2 long, begin long, end long"))

    def hash_windows(batches):
        for batch in blocks(batches, "text"):
            texts, found, wanted = marked(batch, "hot")
            of = found.text[wanted]
            first, count = found.first[wanted] + found.base[of], found.last[wanted] - found.first[wanted] + 1
            begin = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            of = np.repeat(of, count)
            h = [Prefix(v).grams(WINDOW)[begin].view(np.int64) if len(begin) else np.zeros(0, np.int64)
                 for v in (found.hashes, mix(found.hashes + np.uint64(11)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[0]), pa.array(h[1]), batch.column("dk").take(pa.array(of)), batch.column("dk2").take(pa.array(of)), pa.array(begin - found.base[of])],
                ["h1", "h2", "dk", "dk2", "begin"])

    if again.hot:
        windows = (candidates.where(F.size("hot") > 0).select("text", "dk", "dk2", "hot")
                   .mapInArrow(hash_windows, "h1 long, h2 long, dk long, dk2 long, begin long"))
        spans = spans.unionByName(counted_windows(windows).withColumn("end", F.col("begin") + WINDOW))
    return materialize(spans.groupBy("dk", "dk2").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "word-spans")


def _cut(text: bytes, spans) -> tuple[list[bytes], int, int]:
    """The words left of a text, how many it has, and how many are removed."""
    words = text.split()
    if spans is None:
        return words, len(words), 0
    kept, place, removed = [], 0, 0
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        kept += words[place:begin]
        removed += max(0, end - max(begin, place))
        place = max(place, end)
    kept += words[place:]
    return kept, len(words), removed


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    A null or wordless text has no words and the hash of the empty string;
    repeated rows are copies of each other, so that all their windows go; rows
    without doc_id count too."""
    docs = docs.select("doc_id", "text")

    def spans_of(batch):
        at = batch.schema.get_field_index("_spans")
        return batch.column(at).to_pylist() if at >= 0 else [None] * batch.num_rows

    def run(batches):
        for batch in blocks(batches, "text"):
            found = [_cut(t, s) for t, s in zip(as_bytes(batch.column("text")), spans_of(batch), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(x[0])).hexdigest() for x in found])],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    some, others = with_spans(docs, removed_spans(docs), run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return some.unionByName(others)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the recurring passages cut out of ``text`` (the words left,
    one space between them; texts that lose nothing are unchanged). Other columns
    of any name stay."""
    columns, spans = docs.columns, free_name(docs.columns)
    some, others = with_spans(docs, removed_spans(docs.select("doc_id", "text")), name=spans)

    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        return pd.Series([None if t is None else b" ".join(_cut(t.encode(), s)[0]).decode() for t, s in zip(text, spans, strict=True)])

    changed = F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut("text", spans))
    return some.withColumn("text", changed).select(*columns).unionByName(others)


def oracle(source: str) -> str:
    """DuckDB SQL of ``report``: every window as text, counted over all rows."""
    frame = f"(PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM {source}),
words AS (SELECT id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM docs),
windows AS (SELECT id, i, word, count(*) OVER {frame} AS n, md5(string_agg(word, ' ') OVER {frame}) AS h FROM words),
marked AS (SELECT id, i, word, n = {WINDOW} AND count(*) OVER (PARTITION BY h, n) > 1 AS recurs FROM windows),
kept AS (SELECT id, i, word, bool_or(recurs) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM marked),
per AS (SELECT id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
               string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS rest FROM kept GROUP BY id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN per USING (id)
"""
