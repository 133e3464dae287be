"""Removing long repeated byte strings by a distributed merge sort of suffixes.

Every 400-byte window has an anchor (``anchors``); the suffixes that start at
anchors whose key recurs are sorted over all documents. Each map task sorts
its suffixes into a run, front-codes it (length of the prefix shared with the
suffix before, and the rest) and sends each range of the run to the task
that owns the range. That task merges the runs with a loser tree that knows,
of every contender, how much it shares with the last suffix put out, so that
known prefixes are never compared again. The lengths shared by neighbours,
with those of the bytes left of the anchors, tell which windows recur.
"""

from __future__ import annotations

import bisect
import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.anchors import HOT, Sieve, counted_windows, keyed, recurring, with_spans
from bancalyt.llm.common import BLOCK_BYTES, as_bytes, blocks, free_name, materialize, release_memory, workers_find_package
from bancalyt.llm.rolling import BYTE_VALUES, Prefix, mix, window_anchors

WINDOW = 400
#: shorter windows leave an anchor fewer bytes than its GRAM
MIN_WINDOW = 50
#: bytes whose hash orders the positions
GRAM = 16
#: suffixes of one sorted run, and of one merged range on average
RUN = 1 << 15
RANGE = 1 << 14
#: copies of a passage that are cut to suffixes in one task, on average
COPIES = 500
#: ranges are cut by the bytes of a key, so that a cut parts any two keys but
#: never one key's suffixes; one recurring anchor in how many gives a sample of
#: them (anchors, not keys: a key counts as often as it occurs)
SAMPLE = 64
MAX_SAMPLE = 100_000


def width_of(window: int) -> int:
    """The first positions of a window among which its anchor is chosen; the
    bytes of a key are the ``window - width + 1`` that follow any of them."""
    return min(256, window * 16 // 25)


class Anchored:
    """Anchors of the windows of some texts: arrays ``text`` (number), ``at``,
    ``first`` and ``last`` (window starts of the anchor) and ``key``."""

    def __init__(self, texts: list[bytes], window: int = WINDOW):
        self.window = window
        parts = []
        for group in self._groups(texts):
            parts.append(self._anchors(texts, group))
        self.text, self.at, self.first, self.last, self.key = (
            np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(5))

    def _groups(self, texts):
        """(text, begin, starts) pieces of long texts, about BLOCK_BYTES together."""
        group, total = [], 0
        for i, text in enumerate(texts):
            count = len(text) - self.window + 1
            for base in range(0, max(0, count), BLOCK_BYTES):
                starts = min(BLOCK_BYTES, count - base)
                if group and total + starts > BLOCK_BYTES:
                    yield group
                    group, total = [], 0
                group.append((i, base, starts))
                total += starts + self.window
        if group:
            yield group

    def _anchors(self, texts, group):
        window, width = self.window, width_of(self.window)
        data = np.frombuffer(b"".join(texts[i][b:b + n + window - 1] for i, b, n in group), np.uint8)
        number, base, count = (np.array(x, np.int64) for x in zip(*group, strict=True))
        size = count + window - 1
        offset = np.cumsum(size) - size
        prefix = Prefix(BYTE_VALUES[data])
        valid = np.zeros(len(data) + 1, np.int8)
        valid[offset] += 1
        valid[offset + count] -= 1
        starts = np.flatnonzero(np.cumsum(valid[:-1], dtype=np.int8))
        at, first, last = window_anchors(prefix.grams(GRAM), starts, width)
        piece = np.searchsorted(offset, first, "right") - 1
        move = base[piece] - offset[piece]
        key = prefix.hashes(at, at + window - width + 1).view(np.int64)
        return number[piece], at + move, first + move, last + move, key


def shared(a: bytes, b: bytes, known: int) -> int:
    """The length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    x, y = a[known:end], b[known:end]
    if x == y:
        return end
    differ = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
    return known + ((differ & -differ).bit_length() - 1) // 8


class Run:
    """A sorted run of suffixes, front-coded, with what each one carries:
    bytes left of the anchor (front-coded from the anchor leftwards), offsets of
    its windows, place and row keys."""

    FIXED = (("lcp", "<u2"), ("rest", "<u2"), ("low", "u1"), ("high", "u1"), ("left_lcp", "u1"), ("at", "<i8"), ("dk", "<i8"), ("dk2", "<i8"))

    @staticmethod
    def pack(entries: list[tuple]) -> bytes:
        """entries: (suffix, reversed left, low, high, at, dk, dk2), ascending."""
        columns = {name: [] for name, _ in Run.FIXED}
        rests, lefts = [], []
        before = before_left = b""
        for suffix, left, low, high, at, dk, dk2 in entries:
            lcp, left_lcp = shared(before, suffix, 0), shared(before_left, left, 0)
            rests.append(suffix[lcp:])
            lefts.append(left[left_lcp:])
            for name, value in zip(columns, (lcp, len(suffix) - lcp, low, high, left_lcp, at, dk, dk2), strict=True):
                columns[name].append(value)
            before, before_left = suffix, left
        head = b"".join(np.array(columns[name], kind).tobytes() for name, kind in Run.FIXED)
        body = len(entries).to_bytes(4, "little") + head + b"".join(rests) + b"".join(lefts)
        return zstandard.ZstdCompressor(level=1).compress(body)

    def __init__(self, blob: bytes):
        body = zstandard.ZstdDecompressor().decompress(blob)
        n, place = int.from_bytes(body[:4], "little"), 4
        for name, kind in self.FIXED:
            values = np.frombuffer(body, kind, n, place)
            setattr(self, name, values)
            place += values.nbytes
        self.size, self.suffixes, self.lefts = n, [], []
        before = b""
        for lcp, rest in zip(self.lcp.tolist(), self.rest.tolist(), strict=True):
            before = before[:lcp] + body[place:place + rest]
            place += rest
            self.suffixes.append(before)
        before = b""
        for lcp, high in zip(self.left_lcp.tolist(), self.high.tolist(), strict=True):
            before = before[:lcp] + body[place:place + high - lcp]
            place += high - lcp
            self.lefts.append(before)


def merge(runs: list[Run]):
    """(run, index, length shared with the suffix before) of all suffixes in order.

    A loser tree: every contender carries the length it shares with the last
    suffix put out. The one that shares more is the smaller; only if both share
    as much are bytes compared, from there on."""
    width = 1
    while width < len(runs):
        width *= 2
    strings = [r.suffixes for r in runs] + [[]] * (width - len(runs))
    lcps = [r.lcp.tolist() for r in runs]
    index = [0] * width
    head: list[bytes | None] = [s[0] if s else None for s in strings]
    known = [0] * width
    losers = [0] * width

    def play(a, b):
        """(winner, loser) of two runs; the loser learns what it shares with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = known[a], known[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        common = shared(x, y, p)
        if common == len(x) or common < len(y) and x[common] < y[common]:
            known[b] = common
            return a, b
        known[a] = common
        return b, a

    winners = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if width > 1 else 0
    while head[best] is not None:
        i = index[best]
        yield best, i, known[best]
        i += 1
        index[best] = i
        if i < len(strings[best]):
            head[best], known[best] = strings[best][i], lcps[best][i]
        else:
            head[best] = None
        node = (best + width) >> 1
        while node:
            best, losers[node] = play(losers[node], best)
            node >>= 1


def repeated_windows(lcp: np.ndarray, lefts: list[bytes], low: np.ndarray, high: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which windows recur: a row per suffix in sorted order, a column per
    offset of the anchor in its window.

    The window at offset o equals another one if the suffixes share
    ``window`` - o bytes and the bytes to the left share o. Both are classes of
    neighbours in a sorted order: of the suffixes (``lcp``), and of the left
    bytes, read leftwards; windows in one class of both are equal."""
    n, width = len(lcp), width_of(window)
    valid = np.zeros((n, width), bool)
    if not n:
        return valid
    joined = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in lefts), np.uint8).reshape(n, width)
    order = np.argsort(joined.view(f"S{width}").ravel(), kind="stable")
    ordered = joined[order]
    differ = ordered[1:] != ordered[:-1]
    left_lcp = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), width)])
    left_class = np.zeros(n, np.int64)
    for o in range(width):
        active = np.flatnonzero((low <= o) & (high >= o))
        if len(active) < 2:
            continue
        left_class[order] = np.cumsum(left_lcp < o)
        classes = np.cumsum(lcp < window - o)[active] * (n + 1) + left_class[active]
        ranked = np.argsort(classes, kind="stable")
        same = classes[ranked][1:] == classes[ranked][:-1]
        hit = np.zeros(len(active), bool)
        hit[ranked[1:][same]] = True
        hit[ranked[:-1][same]] = True
        valid[active, o] = hit
    return valid


def _spans(runs: list[Run], window: int = WINDOW) -> dict[str, np.ndarray]:
    """The bytes covered by recurring windows, of one merged range."""
    found = list(merge(runs))
    lcp = np.array([x[2] for x in found], np.int64)
    cluster = np.cumsum(lcp < window - width_of(window) + 1)
    alone = np.bincount(cluster)[cluster] < 2
    keep = np.flatnonzero(~alone)
    run, i = (np.array([found[k][j] for k in keep.tolist()], np.int64) for j in (0, 1))
    take = lambda name: np.fromiter((getattr(runs[r], name)[k] for r, k in zip(run.tolist(), i.tolist(), strict=True)), np.int64, len(keep))
    low, high, at, dk, dk2 = map(take, ("low", "high", "at", "dk", "dk2"))
    valid = repeated_windows(lcp[keep], [runs[r].lefts[k] for r, k in zip(run.tolist(), i.tolist(), strict=True)], low, high, window)
    edge = np.diff(np.pad(valid.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1] - 1
    return {"dk": dk[row], "dk2": dk2[row], "begin": at[row] - end, "end": at[row] - begin + window}


def removed_spans(docs: DataFrame, hot: int = HOT, window: int = WINDOW) -> DataFrame:
    """(dk, dk2, spans): per row key of ``anchors.keyed`` the array of (begin,
    end) of the byte strings to remove, in any order, maybe overlapping: those of
    ``window`` bytes (MIN_WINDOW at least) that start at two places or more."""
    if window < MIN_WINDOW:
        raise ValueError(f"a string has {MIN_WINDOW} bytes at least")
    cut_at = window - width_of(window) + 1
    spark = docs.sparkSession
    workers_find_package(spark)
    rows = keyed(docs)

    def list_anchors(batches):
        for batch in blocks(batches, "text"):
            texts = as_bytes(batch.column("text"))
            found = Anchored(texts, window)
            row = batch.column("dk").to_numpy().view(np.uint64)[found.text]
            sample = (mix(found.key.view(np.uint64) ^ mix(row + found.at.astype(np.uint64))) % np.uint64(SAMPLE)) == 0
            cut = [texts[t][a:a + cut_at] if s else None for t, a, s in zip(found.text.tolist(), found.at.tolist(), sample.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.key), batch.column("dk").take(pa.array(found.text)), pa.array(found.at), pa.array(cut, pa.binary())],
                ["key", "dk", "at", "cut"])

    listed = materialize(rows.select("text", "dk").mapInArrow(list_anchors, "key long, dk long, at long, cut binary"), "byte-anchors")
    again = recurring(listed, hot)
    samples = (listed.where("cut is not null").join(again.counts.where(F.col("n") <= hot), "key")
               .orderBy(F.xxhash64("dk", "at")).limit(MAX_SAMPLE).select("cut").collect())
    ranges = max(1, math.ceil(again.cold / RANGE))
    cuts = sorted(bytes(r.cut) for r in samples)
    cuts = sorted({cuts[len(cuts) * i // ranges] for i in range(1, ranges)}) if cuts else []
    candidates = Sieve(again.places).split(rows, True).join(again.places, "dk")

    def marked(batch, column):
        """Texts and anchors, with which anchors are listed in ``column``."""
        texts = as_bytes(batch.column("text"))
        found = Anchored(texts, window)
        lists = batch.column(column)
        offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
        pairs = np.repeat(np.arange(len(texts)), np.diff(offsets)) << 40 | values[offsets[0]:offsets[-1]]
        return texts, found, np.isin(found.text << 40 | found.at, pairs)

    def sort_runs(batches):
        entries = []

        def flush():
            entries.sort(key=lambda e: e[0])
            begin = 0
            for target in range(len(cuts) + 1):
                end = bisect.bisect_left(entries, cuts[target], begin, key=lambda e: e[0][:cut_at]) if target < len(cuts) else len(entries)
                if end > begin:
                    yield target, Run.pack(entries[begin:end])
                begin = end
            entries.clear()
            release_memory()

        def rows_of(pieces):
            targets, blobs = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(targets, pa.int32()), pa.array(blobs, pa.binary())], ["target", "run"])

        for batch in blocks(batches, "text"):
            texts, found, wanted = marked(batch, "cold")
            dk, dk2 = (batch.column(c).to_pylist() for c in ("dk", "dk2"))
            for t, at, first, last in zip(*(x[wanted].tolist() for x in (found.text, found.at, found.first, found.last)), strict=True):
                text = texts[t]
                entries.append((text[at:last + window], text[first:at][::-1], at - last, at - first, at, dk[t], dk2[t]))
            if len(entries) >= RUN:
                yield rows_of(list(flush()))
        if entries:
            yield rows_of(list(flush()))

    def merge_runs(batches):
        current, blobs = None, []

        def flush():
            found = _spans([Run(b) for b in blobs], window)
            release_memory()
            return pa.RecordBatch.from_arrays([pa.array(v) for v in found.values()], list(found))

        for batch in batches:
            for target, blob in zip(batch.column("target").to_pylist(), batch.column("run").to_pylist(), strict=True):
                if target != current and blobs:
                    yield flush()
                    blobs = []
                current = target
                blobs.append(blob)
        if blobs:
            yield flush()

    # documents that share a recurring key meet before they are cut to suffixes,
    # so that a run front-codes their copies; large groups go to several tasks
    share = F.pmod(F.col("dk"), F.ceil(F.col("copies") / COPIES).cast("long"))
    spans = (candidates.where(F.size("cold") > 0).select("text", "dk", "dk2", "cold", "home", share.alias("share"))
             .repartition("home", "share").mapInArrow(sort_runs, "target int, run binary")
             .repartition("target").sortWithinPartitions("target").mapInArrow(merge_runs, "dk long, dk2 long, begin long, end long"))

    def hash_windows(batches):
        other = mix(BYTE_VALUES + np.uint64(11))
        for batch in blocks(batches, "text"):
            texts, found, wanted = marked(batch, "hot")
            dk, dk2 = (batch.column(c).to_numpy() for c in ("dk", "dk2"))
            for t in np.unique(found.text[wanted]).tolist():
                of = wanted & (found.text == t)
                begin = np.concatenate([np.arange(a, b + 1) for a, b in zip(found.first[of], found.last[of], strict=True)])
                data = np.frombuffer(texts[t], np.uint8)
                for k in range(0, len(begin), BLOCK_BYTES):
                    b = begin[k:k + BLOCK_BYTES]
                    lo, hi = b.min(), b.max() + window
                    h = [Prefix(v[data[lo:hi]]).hashes(b - lo, b - lo + window).view(np.int64) for v in (BYTE_VALUES, other)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[0]), pa.array(h[1]), pa.array(np.full(len(b), dk[t])), pa.array(np.full(len(b), dk2[t])), pa.array(b)],
                        ["h1", "h2", "dk", "dk2", "begin"])

    if again.hot:
        windows = (candidates.where(F.size("hot") > 0).select("text", "dk", "dk2", "hot")
                   .mapInArrow(hash_windows, "h1 long, h2 long, dk long, dk2 long, begin long"))
        spans = spans.unionByName(counted_windows(windows).withColumn("end", F.col("begin") + window))
    return materialize(spans.groupBy("dk", "dk2").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "byte-spans")


def _cut(text: bytes, spans) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the number of removed stretches."""
    if spans is None:
        return text, 0, 0
    kept, removed, stretches, place = [], 0, 0, -1
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if begin > place:
            kept.append(text[max(place, 0):begin])
            stretches += 1
            place = begin
        removed += max(0, end - place)
        place = max(place, end)
    kept.append(text[place:])
    return b"".join(kept), removed, stretches


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    A null text is empty; repeated rows are copies of each other, so that all
    their strings of 400 bytes or more go; rows without doc_id count too."""
    docs = docs.select("doc_id", "text")

    def spans_of(batch):
        at = batch.schema.get_field_index("_spans")
        return batch.column(at).to_pylist() if at >= 0 else [None] * batch.num_rows

    def run(batches):
        for batch in blocks(batches, "text"):
            texts = as_bytes(batch.column("text"))
            found = [_cut(t, s) for t, s in zip(texts, spans_of(batch), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                 pa.array([x[2] for x in found], pa.int64()), pa.array([hashlib.sha256(x[0]).hexdigest() for x in found])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    some, others = with_spans(docs, removed_spans(docs), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return some.unionByName(others)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the strings of ``window`` bytes that start at two places or
    more cut out of ``text``; every row stays, with its other columns of any name.

    Where a cut parts the bytes of one character, these bytes go too."""
    columns, spans = docs.columns, free_name(docs.columns)
    some, others = with_spans(docs, removed_spans(docs.select("doc_id", "text"), window=window), name=spans)

    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        return pd.Series([None if t is None else _cut(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(text, spans, strict=True)])

    changed = F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut("text", spans))
    return some.withColumn("text", changed).select(*columns).unionByName(others)
