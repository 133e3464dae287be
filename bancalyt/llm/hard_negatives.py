"""Hard negatives by a secondary sort.

Anchors meet the rows in blocks: a task scores one block of anchors against one
block of rows and keeps, per anchor, only what can still be in the answer (the
first few positives of the block; then, once the positives are known, the first
few negatives of the block inside each positive's window). These pairs carry
the key (anchor, descending score, positives first, id), are dealt by anchor
and sorted within the partitions (``repartition`` and ``sortWithinPartitions``,
the DataFrame form of repartitionAndSortWithinPartitions), and one streaming
pass opens a window at each positive and writes negatives into the open ones.
It holds the open windows of one anchor, never the anchor's rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bancalyt.llm.common import materialize, workers_find_package

POSITIVES = 5
NEGATIVES = 5
#: a negative's score lies between these percentages of the positive's
LOW, HIGH = 80, 100
#: components are floor(SCALE * x)
SCALE = 256
#: rows, and anchors, of a block on average
BLOCK = 1 << 14
#: scores that are held at once
SCORES = 1 << 22

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_MIN, _MAX = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def usable(rows: DataFrame, label: Column | None = None, column: str = "embedding") -> DataFrame:
    """(vec_id, label, q) of the rows that take part: an id, a label, and a vector
    of finite components, which become the integers floor(256 * x) (those beyond
    64 bits stop there). Of several rows with one id, the smallest by label and
    vector counts."""
    v = F.col("v")
    held = rows.select(F.col("vec_id").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                       F.col(column).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = held.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()).where(finite)
    q = F.transform(v, lambda x: F.floor(x * F.lit(float(SCALE))).cast("long"))
    one = held.select("vec_id", F.struct("label", q.alias("q")).alias("r")).groupBy("vec_id").agg(F.min("r").alias("r"))
    return one.select("vec_id", F.col("r.label").alias("label"), F.col("r.q").alias("q"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def scores_of(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; those beyond 64 bits stop there."""
    if not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)), np.int64)
    top = float(np.abs(anchors.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0)) * anchors.shape[1]
    if top < 2 ** 52:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    exact = anchors.astype(object) @ rows.astype(object).T
    return np.minimum(np.maximum(exact, _MIN + 1), _MAX).astype(np.int64)


def _first(scores: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest masked scores of each row; ties to the
    smaller column (columns stand by id)."""
    held = np.where(mask, scores, _MIN)
    if held.shape[1] > k:
        mask = mask & (held >= np.partition(held, -k, axis=1)[:, -k, None])
    row, col = np.nonzero(mask)
    order = np.lexsort((col, -held[row, col], row))
    row, col = row[order], col[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], col[kept]


def _blocks(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows, and anchors, with the keys of the blocks in which they meet."""
    row_blocks = max(1, math.ceil(rows.count() / BLOCK))
    anchor_blocks = max(1, math.ceil(anchors.count() / BLOCK))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    width = F.size("q").alias("width")
    return (rows.select("*", width, block(row_blocks).alias("rb")).withColumn("ab", every(anchor_blocks)),
            anchors.select("*", width, block(anchor_blocks).alias("ab")).withColumn("rb", every(row_blocks)))


def _pairs(rows: DataFrame, anchors: DataFrame, pick) -> DataFrame:
    """(anchor, id, score): what ``pick`` keeps of each block of anchors and rows."""
    left, right = _blocks(rows, anchors)
    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = []
        if mine.num_rows and theirs.num_rows:
            theirs = theirs.sort_by("vec_id")
            ids, labels, own = theirs.column("vec_id").to_numpy(), theirs.column("label").to_numpy(), _matrix(theirs.column("q"))
            step = max(1, SCORES // len(ids))
            for i in range(0, mine.num_rows, step):
                some = mine.slice(i, step)
                names = some.column("vec_id").to_numpy()
                scores = scores_of(_matrix(some.column("q")), own)
                same = some.column("label").to_numpy()[:, None] == labels[None, :]
                row, col = pick(some, scores, same, names[:, None] == ids[None, :])
                out.append(pa.table([names[row], ids[col], scores[row, col]], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    keys = ["width", "ab", "rb"]
    return right.groupBy(*keys).cogroup(left.groupBy(*keys)).applyInArrow(meet, "anchor long, id long, score long")


def _positives(k: int):
    return lambda some, scores, same, own: _first(scores, same & ~own, k)


def _negatives(k: int, low: int, high: int):
    def pick(some, scores, same, own):
        row, col = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        windows = [sorted(w) for w in some.column("windows").to_pylist()]
        for i in range(max(map(len, windows), default=0)):
            # low * p <= 100 * s <= high * p, as bounds of the integer s; none: an empty window
            least = np.array([-(-low * w[i] // 100) if i < len(w) else _MAX for w in windows])
            most = np.array([high * w[i] // 100 if i < len(w) else _MIN for w in windows])
            inside = ~same & (scores >= least[:, None]) & (scores <= most[:, None])
            r, c = _first(scores, inside, k)
            row.append(r)
            col.append(c)
        both = np.unique(np.stack([np.concatenate(row), np.concatenate(col)]), axis=1)
        return both[0], both[1]

    return pick


def windows(batches, k: int, low: int, high: int):
    """The streaming pass over pairs in the order of their keys."""
    anchor, opened = None, []
    for batch in batches:
        out = []
        for name, score, negative, other in zip(*(batch.column(c).to_pylist() for c in ("anchor", "score", "negative", "id")), strict=True):
            if name != anchor:
                anchor, opened = name, []
            if not negative:
                opened.append([other, score, 0])
                continue
            for window in opened:
                if window[2] < k and low * window[1] <= 100 * score <= high * window[1]:
                    window[2] += 1
                    out.append((anchor, window[0], window[2], other, window[1], score))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            [x.split()[0] for x in RESULT.split(", ")])


def mine(rows: DataFrame, is_anchor, label: Column | None = None, column: str = "embedding", positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for whose vec_id ``is_anchor`` holds; an anchor's
    positives are its first ``positives`` other rows of the same label, and each
    positive gets the first ``negatives`` rows of another label whose score is
    at least ``low`` and at most ``high`` percent of its own (``high`` up to 100:
    a window opens at its positive). Higher scores come first, ties by smaller
    vec_id; equal vectors under different ids are rows of their own.

    Rows without id or label and vectors that are null or hold null or
    non-finite components take no part; vectors meet those of their own length
    only (empty ones all score 0). Columns other than vec_id, label and the
    vector are not read. No usable rows: no result rows."""
    if high > 100:
        raise ValueError("a window opens at its positive: high is 100 at most")
    workers_find_package(rows.sparkSession)
    held = materialize(usable(rows, label, column), "rows-of-vectors")
    # columns of their own, for the anchors meet the table that they come from
    anchors = held.where(is_anchor(F.col("vec_id"))).select(*[F.col(c).alias(c) for c in held.columns])
    # the first of each block, then of all: at most ``positives`` pairs of an anchor and block are shuffled
    first = _pairs(held, anchors, _positives(positives))
    by_score = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = first.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= positives).drop("n")
    first = materialize(first, "positives")
    spans = first.groupBy("anchor").agg(F.collect_set("score").alias("windows"))
    asked = anchors.join(spans, anchors.vec_id == spans.anchor).drop("anchor")
    close = _pairs(held, asked, _negatives(negatives, low, high))
    pairs = first.select("anchor", "score", F.lit(False).alias("negative"), "id").unionByName(
        close.select("anchor", "score", F.lit(True).alias("negative"), "id"))
    keyed = pairs.select(F.struct("anchor", F.bitwise_not("score").alias("falling"), "negative", "id").alias("key"), "anchor", "score", "negative", "id")
    ordered = keyed.repartition("anchor").sortWithinPartitions("key").drop("key")
    return ordered.mapInArrow(lambda batches: windows(batches, negatives, low, high), RESULT)


ORACLE = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM {embeddings}
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * r.q[i])), 0) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id AND len(a.q) = len(r.q) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 5
"""
