"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two models, of toxic and of ordinary text, read a word byte by byte. Each
interpolates n-grams of ORDER bytes down to SHARED bytes with absolute
discounting by counts of its own class; below that, both back off to one
Kneser-Ney distribution of the whole labelled text (shared continuation
counts), so that what is rare costs both models the same. A document's score
compares the length-normalised log-likelihoods: the mean over its bytes of
log P(byte | toxic) - log P(byte | ordinary), turned into a probability by a
logistic curve that is fitted on labelled rows the models have not seen.

The difference of the logarithms is a sum of one number per n-gram that the
models hold (an n-gram that neither holds adds what its context's backoff
weights add), so the models are one table (n-gram, weight), counted and worked
out by joins, as large as the labelled text makes it. A fixed number of the
most frequent n-grams, which nearly every document needs, goes to all tasks;
the rest meets the documents in a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.common import Table, as_bytes, blocks, materialize, workers_find_package
from bancalyt.llm.rolling import BYTE_VALUES, Prefix, words_of

#: bytes of the longest n-grams, and of the longest that both classes share
ORDER = 5
SHARED = 2
#: absolute discount of the toxic and shared counts; ordinary counts are
#: discounted by as much more as there is more ordinary text
DISCOUNT = 0.75
#: most frequent n-grams that every task holds (16 bytes each)
HOT = 1 << 20
#: labelled rows that the logistic curve is fitted on, at most
CALIBRATION = 100_000
#: labels below this many rows are sent to the documents; more are joined by a shuffle
FEW_LABELS = 1 << 20
#: weights are whole numbers of 2**-UNIT, so that sums do not depend on their order
UNIT = 24
#: words whose scores a task remembers; n-gram counts that it holds before it writes them
WORDS = 1 << 17
GRAMS = 1 << 20
#: bits of the sieve of n-grams that are not sent to every task
SIEVE = 1 << 26

#: ASCII that is neither letter nor digit parts words; other bytes are letters
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 0x20 for b in range(256))


def plain(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode().translate(_PLAIN)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out (null ids too: they have no label)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)), F.lit(0)).cast("int")


def grams_of(words: list[bytes], order: int = ORDER):
    """Per length k = 1 … order of all words, each with a space before and after:
    (word, n-gram, its first k - 1 bytes, its last k - 1 bytes, the n-gram with one
    byte more to the left or 0), as 64-bit hashes. The space before is context only."""
    padded = [b" " + w + b" " for w in words]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    data = np.frombuffer(b"".join(padded), np.uint8)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    prefix = Prefix(BYTE_VALUES[data])
    ends = {}
    for k in range(order + 1):
        at = np.zeros(len(data), np.uint64)
        if k and len(data) >= k:
            at[k - 1:] = prefix.grams(k)
        ends[k] = at
    for k in range(1, order + 1):
        last = np.flatnonzero(place >= max(k - 1, 1))
        longer = np.where(place[last] >= k, ends[k + 1][last], 0) if k < order else np.zeros(len(last), np.uint64)
        yield k, owner[last], ends[k][last], ends[k - 1][last - 1] if k > 1 else np.zeros(len(last), np.uint64), ends[k - 1][last], longer


def count_grams(batches):
    """(gram, longer, k, head, tail, toxic, ordinary) of a task's labelled texts: how
    often each n-gram stands in toxic and in ordinary text. ``longer`` tells the left
    contexts of the shared orders apart (0 elsewhere)."""
    schema = pa.schema([("gram", pa.int64()), ("longer", pa.int64()), ("k", pa.int32()), ("head", pa.int64()), ("tail", pa.int64()),
                        ("toxic", pa.int64()), ("ordinary", pa.int64())])
    keys, sums = schema.names[:5], schema.names[5:]
    held: list[pa.Table] = []
    rows = 0

    def merged() -> pa.Table:
        whole = pa.concat_tables(held).group_by(keys).aggregate([(c, "sum") for c in sums])
        return whole.select([*keys, *(f"{c}_sum" for c in sums)]).rename_columns(schema.names)

    for batch in blocks(batches, "text"):
        texts = [plain(t) for t in as_bytes(batch.column("text"))]
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False) > 0
        first, last, hashes, owner, _ = words_of(texts)
        joined = b"\n".join([*texts, b""])
        _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        counts = [np.bincount(which, toxic[owner] == c, len(at)) for c in (True, False)]
        for i in range(0, len(at), WORDS // 8):
            some = slice(i, i + WORDS // 8)
            words = [joined[a:b] for a, b in zip(first[at[some]].tolist(), last[at[some]].tolist(), strict=True)]
            for k, word, gram, head, tail, longer in grams_of(words):
                if k > SHARED:
                    longer = np.zeros_like(longer)
                _, one, same = np.unique(np.where(longer != 0, longer, gram), return_index=True, return_inverse=True)
                n = [np.bincount(same, c[some][word], len(one)).astype(np.int64) for c in counts]
                held.append(pa.table([gram[one].view(np.int64), longer[one].view(np.int64), np.full(len(one), k, np.int32),
                                      head[one].view(np.int64), tail[one].view(np.int64), *n], schema=schema))
                rows += len(one)
            if rows > GRAMS:
                held = [merged()]
                rows = held[0].num_rows
                if rows > GRAMS // 2:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held, rows = [], 0
    if held:
        yield from merged().to_batches(max_chunksize=1 << 16)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fold) of rows whose id has a label outside the held-out fold;
    of several labels of an id the largest counts."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("_id").agg(F.max("toxic").alias("toxic")))
    known = known.where(fold(F.col("_id")) != 0)
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")).where(fold(F.col("doc_id")) != 0)
    few = labels.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    return rows.join(F.broadcast(known) if few else known, F.col("doc_id") == F.col("_id")).select(
        "doc_id", "text", "toxic", fold(F.col("doc_id")).alias("fold"))


def train(rows: DataFrame) -> DataFrame:
    """(gram, weight, n): the difference that each n-gram makes, in 2**-UNIT, and
    how often it stands in the labelled text; from (text, toxic)."""
    found = rows.select("text", "toxic").mapInArrow(
        count_grams, "gram long, longer long, k int, head long, tail long, toxic long, ordinary long")
    parts_of = [F.any_value(c).alias(c) for c in ("k", "head", "tail")]  # an n-gram has one of each
    counted = found.groupBy("gram", "longer").agg(*parts_of, F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"))
    counts = materialize(
        counted.groupBy("gram").agg(*parts_of, F.sum("t").alias("t"), F.sum("o").alias("o"), F.count("*").alias("lefts")), "gram-counts")
    totals = counts.where("k = 1").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    schema = "gram long, weight long, n long"
    if not totals.t or not totals.o:  # one class only: nothing to compare
        return rows.sparkSession.createDataFrame([], schema)
    # in 64ths, so that sums of discounts are exact
    ordinary = round(DISCOUNT * totals.o / totals.t * 64) / 64
    below = parts = None
    for k in range(1, ORDER + 1):
        own = counts.where(F.col("k") == k)
        if k <= SHARED:
            # one distribution for both classes, from numbers of different left contexts
            by_head = own.groupBy("head").agg(F.sum("lefts").alias("all"), F.sum(F.least("lefts", F.lit(DISCOUNT))).alias("cut"))
            rate = lambda p: (F.greatest(F.col("lefts") - DISCOUNT, F.lit(0.0)) + F.col("cut") * p) / F.col("all")
            joined = own.join(by_head, "head")
            if below is None:
                level = joined.select("gram", rate(F.lit(1 / 256)).alias("pt"))
            else:
                level = joined.join(below.select(F.col("gram").alias("tail"), "pt"), "tail").select("gram", rate(F.col("pt")).alias("pt"))
            level = level.select("gram", "pt", F.col("pt").alias("po"), F.lit(0.0).alias("own"))
        else:
            by_head = own.groupBy("head").agg(
                F.sum("t").alias("all_t"), F.sum("o").alias("all_o"),
                F.sum(F.least("t", F.lit(DISCOUNT))).alias("cut_t"), F.sum(F.least("o", F.lit(ordinary))).alias("cut_o"))
            weight = lambda c: F.when(F.col(f"all_{c}") > 0, F.col(f"cut_{c}") / F.col(f"all_{c}")).otherwise(1.0)
            by_head = by_head.select("head", "all_t", "all_o", weight("t").alias("wt"), weight("o").alias("wo"))
            by_head = materialize(by_head.withColumn("backoff", F.log("wt") - F.log("wo")), f"contexts-{k}")
            rate = lambda c, d: (F.when(F.col(f"all_{c}") > 0, F.greatest(F.col(c) - d, F.lit(0.0)) / F.col(f"all_{c}")).otherwise(0.0)
                                 + F.col(f"w{c}") * F.col(f"p{c}"))
            level = (own.join(by_head, "head").join(below.select(F.col("gram").alias("tail"), "pt", "po"), "tail")
                     .select("gram", rate("t", DISCOUNT).alias("nt"), rate("o", ordinary).alias("no"), "backoff", "pt", "po"))
            # what the n-gram adds beside its context's backoff and its own last bytes
            level = level.select("gram", F.col("nt").alias("pt"), F.col("no").alias("po"),
                                 (F.log("nt") - F.log("no") - F.col("backoff") - F.log("pt") + F.log("po")).alias("own"))
            heads = by_head.select(F.col("head").alias("gram"), F.col("backoff").alias("value"))
            parts = heads if parts is None else parts.unionByName(heads)
        level = materialize(level, f"level-{k}")
        below = level
        if k > SHARED:
            parts = parts.unionByName(level.select("gram", F.col("own").alias("value")))
    unit = F.round(F.col("value") * F.lit(float(1 << UNIT))).cast("long")
    weights = parts.groupBy("gram").agg(F.sum(unit).alias("weight")).where("weight <> 0")
    model = weights.join(counts.select("gram", (F.col("t") + F.col("o")).alias("n")), "gram")
    return materialize(model.select("gram", "weight", "n"), "toxicity-model")


class Weights:
    """The most frequent n-grams with their weights, and a sieve of the others."""

    def __init__(self, model: DataFrame):
        hot = model.orderBy(F.desc("n"), "gram").limit(HOT).toArrow()
        grams, weights, n = (hot.column(c).to_numpy() for c in ("gram", "weight", "n"))
        order = np.argsort(grams)
        self.grams, self.weights, self.bits = grams[order], weights[order], None
        if len(grams) == HOT:
            least = int(n.min())
            last = int(grams[n == least].max())
            self.rest = model.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("gram") > last)))
            slot = F.pmod("gram", F.lit(SIEVE))
            words = (self.rest.select(slot.alias("s")).groupBy(F.shiftright("s", 6).cast("int").alias("w"))
                     .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b")).toArrow())
            self.bits = np.zeros(SIEVE // 64, np.uint64)
            self.bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)

    def of(self, words: list[bytes]) -> list[tuple[int, list[int]]]:
        """Of each word: the sum of the weights held here, and the n-grams that may
        have a weight elsewhere."""
        total = np.zeros(len(words))  # whole numbers far below 2**53
        others: list[list[int] | tuple] = [()] * len(words)
        for k, word, gram, _, _, _ in grams_of(words):
            if k < SHARED:
                continue
            gram = gram.view(np.int64)
            at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
            hit = self.grams[at] == gram
            total += np.bincount(word[hit], self.weights[at[hit]], len(words))
            if self.bits is not None:
                slot = np.mod(gram, SIEVE)
                may = ~hit & ((self.bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1)
                for i, g in zip(word[may].tolist(), gram[may].tolist(), strict=True):
                    others[i] = [*others[i], g]
        return list(zip(total.astype(np.int64).tolist(), others, strict=True))


def measured(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, fold, ratio: the mean difference of the log-likelihoods per byte of
    the words of each row's text (0 without words)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"),
                       F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"))
    name = rows.schema["doc_id"].dataType.simpleString()
    held = Weights(model) if model.limit(1).count() else None
    if held is None:
        return rows.select("doc_id", fold(F.col("doc_id")).alias("fold"), F.lit(0.0).alias("ratio"))
    shared = spark.sparkContext.broadcast((held.grams, held.weights, held.bits))

    def run(batches):
        weights = Weights.__new__(Weights)
        weights.grams, weights.weights, weights.bits = shared.value
        known = Table(WORDS)
        for batch in blocks(batches, "text"):
            texts = [plain(t) for t in as_bytes(batch.column("text"))]
            size, total, others, times = [], [], [], []
            split = [t.split() for t in texts]
            table = known.holding(set().union(*split), weights.of) if texts else {}
            for words in split:
                size.append(sum(map(len, words)) + len(words))
                found = [table[w] for w in words]
                total.append(sum(f[0] for f in found))
                rest: dict[int, int] = {}
                for _, grams in found:
                    for g in grams:
                        rest[g] = rest.get(g, 0) + 1
                others.append(list(rest))
                times.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "h1", "h2")), pa.array(size, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(others, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                ["doc_id", "h1", "h2", "size", "total", "others", "times"])

    scored = rows.mapInArrow(run, f"doc_id {name}, h1 long, h2 long, size long, total long, others array<long>, times array<long>")
    scored = materialize(scored, "toxicity-sums")
    if held.bits is not None:
        # equal texts ask once; a weight that many texts ask for is a join key that adaptive execution splits
        asked = (scored.where(F.size("others") > 0).select("h1", "h2", F.explode(F.arrays_zip("others", "times")).alias("x"))
                 .select("h1", "h2", F.col("x.others").alias("gram"), F.col("x.times").alias("times")).distinct())
        more = asked.join(held.rest.select("gram", "weight"), "gram").groupBy("h1", "h2").agg(F.sum(F.col("times") * F.col("weight")).alias("more"))
        more = materialize(more, "toxicity-more")
        scored = scored.join(more, ["h1", "h2"], "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0)))
    ratio = F.when(F.col("size") > 0, F.col("total") / F.lit(float(1 << UNIT)) / F.col("size")).otherwise(0.0)
    return scored.select("doc_id", fold(F.col("doc_id")).alias("fold"), ratio.alias("ratio"))


def curve(ratio: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve through labelled ratios; without rows
    of both classes the ratio itself is the logit."""
    if len(set(toxic.tolist())) < 2:
        return 1.0, 0.0
    scale = float(ratio.std()) or 1.0
    x = np.stack([ratio / scale, np.ones(len(ratio))], axis=1)
    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (toxic - p) - 1e-3 * at)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]) / scale, float(at[1])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, ratio of every row of ``docs``.

    The models learn from labelled rows of folds 2 to 4 (``fold``: crc32 of the id
    modulo 5), the curve from at most CALIBRATION labelled rows of fold 1; fold 0
    is held out of both. A score depends on the text alone: equal texts score
    equally, null and wordless texts have ratio 0. Ids that repeat are rows of
    their own; labels that are null or without id are not used, and of several
    labels of one id the largest counts. Without labels of both classes every
    score is 0.5 or what the curve gives. Other columns are not read."""
    workers_find_package(docs.sparkSession)
    known = labelled(docs, labels)
    model = train(known.where("fold > 1"))
    found = materialize(measured(docs, model), "toxicity-ratios")
    marks = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) == 1)).groupBy("_id").agg(F.max("toxic").alias("toxic")))
    fitted = (found.where("fold = 1").join(marks, F.col("doc_id") == F.col("_id")).select("ratio", "toxic", F.xxhash64("doc_id").alias("h"))
              .orderBy("h", "ratio").limit(CALIBRATION).toArrow())
    slope, offset = curve(fitted.column("ratio").to_numpy(), fitted.column("toxic").to_numpy().astype(np.float64))
    score = 1 / (1 + F.exp(-(F.col("ratio") * slope + offset)))
    found = found.select("doc_id", (F.col("fold") == 0).alias("held_out"), score.alias("score"), "ratio")
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), "ratio")
