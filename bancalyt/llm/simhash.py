"""SimHash near-duplicates through anchors of a covering code.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 2 of
their upper 32 bits or in at most 1 of their lower 32 bits (else 3 + 2 = 5).
Each half is covered by anchors: the words of the [31, 26] Hamming code on 31
of its bits, with the last bit free, which lie within radius 1 of every
value. A fingerprint goes to the anchor nearest to its half (its home) and to
every anchor within radius + threshold of it (3 above, 2 below); a partner's
half lies within the threshold, so the partner's home is among them. Each
anchor compares its home fingerprints with all fingerprints that reached it.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.anchors import second_key
from bancalyt.llm.common import as_bytes, blocks, doc_key, materialize, workers_find_package
from bancalyt.llm.components import components
from bancalyt.llm.rolling import word_spans

MAX_BITS = 4
SHINGLE = 4
SEED = 42
#: differing bits that the upper and the lower half may have
HALF_BITS = (2, 1)
#: home fingerprints of one anchor that one task compares
HOME_BLOCK = 1 << 15

#: A-Z to lower case, every separator to a space
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as a signed 64-bit integer; no words: 0."""
    data = text.translate(_FOLD)
    begin, end = word_spans(np.frombuffer(data, np.uint8))
    if not len(begin):
        return 0
    if int((end - begin).sum()) + len(begin) - 1 != len(data):  # some words were further apart
        data = b" ".join(data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True))
        begin, end = word_spans(np.frombuffer(data, np.uint8))
    last = end[min(shingle, len(end)) - 1:].tolist()
    view, one = memoryview(data), xxhash.xxh64_intdigest
    total, ones = 0, np.zeros(64, np.int64)
    step = 1 << 15  # bounds the bit table of a very long text
    for i in range(0, len(last), step):
        h = np.array([one(view[a:b], SEED) for a, b in zip(begin[i:i + step].tolist(), last[i:i + step], strict=False)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    value = sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, key2, fp) of every row; the two 64-bit keys tell rows apart by
    id and text."""
    workers_find_package(docs.sparkSession)

    def run(batches):
        for batch in blocks(batches, "text"):
            fp = [fingerprint(t, shingle) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "key2")), pa.array(fp, pa.int64())], ["doc_id", "key", "key2", "fp"])

    return (docs.select("doc_id", "text", doc_key().alias("key"), second_key().alias("key2"))
            .mapInArrow(run, "doc_id long, key long, key2 long, fp long"))


def _patterns() -> list[tuple[int, int, int, int]]:
    """(half, syndrome, home, flips): what turns a half with this syndrome into
    an anchor within radius 1 + threshold; 31 * 32 rows of each half on average,
    a fixed table of under 7,000 rows. Bit i (0 to 30) has the syndrome i + 1;
    bit 31 is the free one."""
    rows = []
    for half, threshold in enumerate(HALF_BITS):
        for weight in range(0, 2 + threshold):
            for bits in itertools.combinations(range(32), weight):
                syndrome = flips = 0
                for b in bits:
                    flips |= 1 << b
                    syndrome ^= b + 1 if b < 31 else 0
                home = flips == (1 << syndrome - 1 if syndrome else 0)
                rows.append((half, syndrome, int(home), flips))
    return rows


def _syndrome(half):
    """SQL expression of the five parities of a half."""
    out = F.lit(0)
    for j in range(5):
        mask = sum(1 << i for i in range(31) if (i + 1) >> j & 1)
        out = out + F.bit_count(half.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1)) * (1 << j)
    return out.cast("int")


def anchored(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home) for distinct fingerprints (column ``fp``)."""
    spark = fps.sparkSession
    table = spark.createDataFrame(_patterns(), "half int, syndrome int, home int, flips long")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    halves = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("half"), high.alias("bits")), F.struct(F.lit(1).alias("half"), low.alias("bits")))).alias("x"))
    halves = halves.select("fp", "x.half", "x.bits", _syndrome(F.col("x.bits")).alias("syndrome"))
    return (halves.join(F.broadcast(table), ["half", "syndrome"])
            .select((F.col("bits").bitwiseXOR(F.col("flips")) + F.col("half") * F.lit(1 << 32)).alias("anchor"), "fp", "home"))


def _near(left: np.ndarray, right: np.ndarray, max_bits: int) -> np.ndarray:
    # unsigned: numpy counts the bits of a signed number's absolute value
    return np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= max_bits


def _forest(left: np.ndarray, right: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what is within ``max_bits``: ``left`` against ``right``,
    of which it is a part; fewer links than fingerprints. Blocks bound the
    memory, and a group that has become one is not compared any further."""
    label = np.arange(len(right))
    order = np.argsort(right)
    place = order[np.searchsorted(right[order], left)]
    out, parts = [], len(right)
    step = max(1, (1 << 21) // len(right))
    for i in range(0, len(left), step):
        if parts == 1:
            break
        near = _near(left[i:i + step], right, max_bits)
        near[np.arange(len(near)), place[i:i + step]] = False
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            own = place[i + k]
            met = np.flatnonzero(near[k])
            labels, first = np.unique(label[met], return_index=True)
            for other, at in zip(labels.tolist(), met[first].tolist(), strict=True):
                if other != label[own]:
                    out.append((int(right[own]), int(right[at])))
                    label[label == other] = label[own]
                    parts -= 1
            if parts == 1:
                break
    return out


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links among distinct fingerprints that span the same groups as
    all pairs within ``max_bits`` do (of one anchor, never more links than
    fingerprints)."""
    if not 0 <= max_bits <= sum(HALF_BITS) + 1:
        raise ValueError("the anchors cover up to 4 differing bits")
    workers_find_package(fps.sparkSession)
    rows = anchored(fps)
    # an anchor with many home fingerprints is dealt to several tasks: the
    # homes are split, whatever else reached the anchor goes to each part
    heavy = materialize(rows.where("home = 1").groupBy("anchor").count().where(F.col("count") > HOME_BLOCK)
                        .select("anchor", F.ceil(F.col("count") / HOME_BLOCK).cast("int").alias("parts")), "heavy-anchors")
    if heavy.isEmpty():
        rows = rows.withColumn("part", F.lit(0))
    else:
        rows = rows.join(heavy, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        rows = rows.select("anchor", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.col("home"), own.alias("own"))
        rows = rows.withColumn("home", F.when(F.col("part") == F.col("own"), F.col("home")).otherwise(0))

    def run(batches):
        carry = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if carry is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(carry, columns, strict=True)]
            anchor, part = columns[0], columns[1]
            if not len(anchor):
                continue
            cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
            carry = [c[cut[-1]:] for c in columns] if len(cut) else columns
            if len(cut):
                yield from groups([c[:cut[-1]] for c in columns], cut[:-1])
        if carry is not None:
            yield from groups(carry, np.zeros(0, np.int64))

    def groups(columns, cut):
        _, _, fp, home = columns
        begin = np.concatenate([[0], cut])
        end = np.append(cut, len(fp))
        homes = np.add.reduceat(home, begin)
        out = []
        for b, e in zip(*(x[(homes > 0) & (end - begin > 1)].tolist() for x in (begin, end)), strict=True):
            out += _forest(fp[b:e][home[b:e] == 1], fp[b:e], max_bits)
        if out:
            a, b = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return (rows.select("anchor", "part", "fp", "home").repartition("anchor", "part")
            .sortWithinPartitions("anchor", "part").mapInArrow(run, "a long, b long"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, key, key2, fp, root, component_id) of every row.

    ``root`` is the smallest fingerprint of the component.
    A null or wordless text has the fingerprint 0, linked like any other. The
    component is the smallest doc_id of all rows that links reach; rows without
    doc_id take part and are labelled by the others (null if there is none).
    Repeated rows give repeated results; an empty table gives none."""
    marks = materialize(fingerprints(docs, shingle), "fingerprints")
    fps = materialize(marks.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(fingerprint_links(fps.select("fp"), max_bits))
    named = fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "low")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(named.join(lows, "root").select("fp", "root", "component_id"), "fingerprint-components")
    return marks.join(named, "fp").select("doc_id", "key", "key2", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, one of each group: its smallest by doc_id, then by the
    128-bit key of id and text; of rows equal in both, the smallest by a hash of
    all columns. Rows without doc_id come last in their group. Extra columns of
    any name stay as they are."""
    found = simhash_components(docs.select("doc_id", "text"), shingle, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("key2").alias("k2"))
    best = materialize(found.groupBy("root").agg(F.min(order).alias("w")).select(F.col("w.k").alias("_k"), F.col("w.k2").alias("_k2")), "kept")
    columns = docs.columns
    held = docs.select(doc_key().alias("_k"), second_key().alias("_k2"), F.struct(*[docs[c].alias(f"_c{i}") for i, c in enumerate(columns)]).alias("_row"))
    rows = held.join(best, ["_k", "_k2"], "left_semi")
    one = rows.groupBy("_k", "_k2").agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    return one.select(*[F.col(f"_row._c{i}").alias(c) for i, c in enumerate(columns)])
