"""Token ids in binary shards, each document compressed on its own.

A dictionary for zstandard is trained once on a bounded sample of serialized
id arrays; every document is then one frame compressed with it, so that a short
document can be read alone. A shard is one row of a Parquet table written by
Spark (its commit protocol keeps retried tasks from leaving torn shards, and
any store that Spark writes to will do): the bytes of the frames, an index
(doc_id, offset, length and number of ids of each document), and the hash of
the dictionary that it needs. The dictionary lies beside, in a table of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bancalyt.llm.common import Table, as_bytes, blocks, new_path, taken, wide_space, workers_find_package
from bancalyt.llm.rolling import BYTE_VALUES, Prefix, join_texts, mark_cuts

TOKENIZER = "byte_bpe_50k.json"
END = 0
#: the sample the dictionary is trained on: documents, and bytes of the longest
TRAIN_DOCS = 1_000
TRAIN_BYTES = 1 << 15
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
#: compressed bytes at which a shard is closed
SHARD_BYTES = 4 << 20
RUN_TABLE = 600_000

SHARD = ("part int, shard int, dict_sha256 string, n_docs long, n_ids long, doc_ids array<long>, "
         "offsets array<long>, lengths array<long>, counts array<long>, frames binary")

def white_space_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of the runs of joined texts (one byte between
    two texts) at which the byte-level pattern splits in any case: a word with
    one space before it; of other white space before a word all but its last
    character, and that one; white space at the end of a text; what begins with
    a mark after a letter (both ASCII)."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    inside = np.ones(len(data) + 1, bool)
    inside[end] = False
    word = np.append(~space, False) & inside
    blank = np.append(space, False) & inside
    before = np.zeros_like(word)  # the byte before belongs to the same text
    before[1:] = inside[:-1]
    last = np.zeros_like(word)  # the last white space before a word
    last[:-1] = blank[:-1] & word[1:]
    opens = blank.copy()  # the first of some white space
    opens[1:] &= ~blank[:-1]
    plain = np.zeros_like(word)
    plain[1:] = np.append(data == 0x20, False)[:-1] & blank[:-1]
    first = word.copy()  # the first byte of a word
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero((first & ~plain) | last | opens | np.append(mark_cuts(data), False))
    owner = np.searchsorted(begin, starts, "right") - 1
    stops = np.minimum(np.append(starts[1:], len(data)), end[owner])
    return starts, stops, owner


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    The tokenizer splits at white space before it merges, one space staying
    with what follows. The runs of a block of texts are told apart by rolling
    hashes; each distinct one is looked up in a bounded table, and encoded by
    the library if it is new. A text with one of the file's added tokens, or
    with white space beyond ASCII, goes through the library whole."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"]
        if spec["normalizer"] is not None or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError("runs are encoded apart for plain byte-level files only")
        self.added = [t["content"].encode() for t in spec["added_tokens"]]
        # bytes of each token: a byte-level vocabulary spells every byte as one symbol
        sizes = {i: len(s) for s, i in spec["model"]["vocab"].items()} | {t["id"]: len(t["content"].encode()) for t in spec["added_tokens"]}
        self.sizes = np.zeros(max(sizes) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self.runs = Table(RUN_TABLE)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text.encode()])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, given in UTF-8."""
        whole = [any(t in text for t in self.added) or wide_space(text) for text in texts]
        out = [b""] * len(texts)
        plain = [i for i, w in enumerate(whole) if not w]
        for i, ids in zip(plain, self._encode_plain([texts[i] for i in plain]), strict=True):
            out[i] = ids
        for i, w in enumerate(whole):
            if w:
                out[i] = np.array(self.library.encode(texts[i].decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return out

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        data, begin, end = join_texts(texts)
        starts, stops, owner = white_space_runs(data, begin, end)
        if not len(starts):
            return [b""] * len(texts)
        _, first, which = np.unique(Prefix(BYTE_VALUES[data]).hashes(starts, stops), return_index=True, return_inverse=True)
        joined = data.tobytes()
        runs = [joined[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        found = self.runs.values(runs, self._ids)
        ids, ends = taken(pa.array(found, pa.large_binary()), which)
        cut = ends[np.searchsorted(owner, np.arange(len(texts) + 1))].tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def _ids(self, runs: list[bytes]) -> list[bytes]:
        """The ids of each run. Words with one space before them are encoded
        many at a time, as the text that they make end to end (it is split
        before every such space), and the ids are told apart by their bytes."""
        out: dict[bytes, bytes] = {}
        words = [r for r in runs if len(r) > 1 and r[0] == 0x20 and not r[1:2].isspace()]
        groups = [words[i:i + 256] for i in range(0, len(words), 256)]
        found = self.library.encode_batch_fast([b"".join(g).decode() for g in groups], add_special_tokens=False)
        for group, one in zip(groups, found, strict=True):
            ids = np.array(one.ids, "<u4")
            ends = np.cumsum(self.sizes[ids])
            stops = np.searchsorted(ends, np.cumsum(list(map(len, group)))) + 1
            data, begin = ids.tobytes(), 0
            for word, stop in zip(group, (4 * stops).tolist(), strict=True):
                out[word] = data[begin:stop]
                begin = stop
        others = [r for r in runs if r not in out]
        for run, one in zip(others, self.library.encode_batch_fast([r.decode() for r in others], add_special_tokens=False), strict=True):
            out[run] = np.array(one.ids, "<u4").tobytes()
        return [out[r] for r in runs]


@functools.lru_cache(maxsize=2)
def load(name: str) -> Encoder:
    """The encoder of a file: a path, or a name that public_tokenizers knows."""
    if not os.path.exists(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Encoder(name)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def train(docs: DataFrame, tokenizer: str = TOKENIZER) -> bytes:
    """The shared dictionary, from at most TRAIN_DOCS texts of at most
    TRAIN_BYTES bytes, taken by the hash of their ids; empty if there
    is too little to train on."""
    size, h = F.octet_length("text"), F.xxhash64("doc_id")
    # hashes alone first: texts leave the tasks only for the sample
    last = docs.select(h.alias("h")).orderBy("h").limit(TRAIN_DOCS).agg(F.max("h")).first()[0]
    rows = [] if last is None else docs.where((h <= last) & (size > 0) & (size <= TRAIN_BYTES)).select("text").limit(TRAIN_DOCS).collect()
    samples = load(tokenizer).encode_all([r.text.encode() for r in rows])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END) -> None:
    """Encode every text of ``docs`` (null: empty), append ``end`` to each, and
    write shards in ascending doc_id order under ``path``. Rows without doc_id
    come first; rows with equal ids stand in the order of their texts' hashes."""
    spark = docs.sparkSession
    workers_find_package(spark)
    docs = docs.select("doc_id", "text")
    dictionary = train(docs, tokenizer)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def run(batches):
        from pyspark import TaskContext

        part, own, press = TaskContext.get().partitionId(), load(tokenizer), _compressor(dictionary)
        last = np.array([end], "<u4").tobytes()
        shard, ids, offsets, lengths, counts, frames, total = 0, [], [], [], [], [], 0

        def close():
            row = {"part": part, "shard": shard, "dict_sha256": name, "n_docs": len(ids), "n_ids": sum(counts), "doc_ids": ids,
                   "offsets": offsets, "lengths": lengths, "counts": counts, "frames": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=_arrow_schema())

        for batch in blocks(batches, "text"):
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), own.encode_all(as_bytes(batch.column("text"))), strict=True):
                data += last
                frame = press.compress(data)
                ids.append(doc_id)
                offsets.append(total)
                lengths.append(len(frame))
                counts.append(len(data) // 4)
                frames.append(frame)
                total += len(frame)
                if total >= SHARD_BYTES:
                    yield close()
                    shard, ids, offsets, lengths, counts, frames, total = shard + 1, [], [], [], [], [], 0
        if ids:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (docs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SHARD)
     .write.parquet(f"{path}/shards"))


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in SHARD.split(", ")])


def dictionary_of(spark: SparkSession, path: str) -> tuple[str, bytes]:
    """Hash and bytes of the one dictionary of a store (at most DICTIONARY_BYTES)."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row.dictionary)
    if hashlib.sha256(dictionary).hexdigest() != row.dict_sha256:
        raise ValueError("the dictionary does not have the hash it is named by")
    return row.dict_sha256, dictionary


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, shard, start): ids of all shards before each one. Prefix sums
    within a part, and over the parts' totals (one row per writing task)."""
    index = spark.read.parquet(f"{path}/shards").select("part", "shard", "n_ids")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("ahead"))
    within = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0))
    index = index.select("part", "shard", within.alias("within"))
    return index.join(parts, index.part == parts.p).select("part", "shard", (F.col("ahead") + F.col("within")).alias("start"))


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and the ids (array<long>, or their crc32 as
    ``ids_crc32`` with ``digest``) of the documents of a store, or of those in
    the short list ``doc_ids``, whose frames alone are decompressed."""
    from bancalyt.llm.common import materialize

    workers_find_package(spark)
    name, dictionary = dictionary_of(spark, path)
    shards = spark.read.parquet(f"{path}/shards")
    if doc_ids is not None:
        shards = shards.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(i)) for i in doc_ids])))
    wanted = None if doc_ids is None else set(doc_ids)
    rows = shards.join(materialize(starts(spark, path), "shard-starts"), ["part", "shard"])

    def run(batches):
        press = _decompressor(dictionary)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != name:
                    raise ValueError("a shard was written with another dictionary")
                place, out = row["start"], []
                for doc_id, offset, length, count in zip(row["doc_ids"], row["offsets"], row["lengths"], row["counts"], strict=True):
                    if wanted is None or doc_id in wanted:
                        data = press.decompress(row["frames"][offset:offset + length])
                        out.append((doc_id, place, len(data) // 4, zlib.crc32(data) if digest else np.frombuffer(data, "<u4").astype(np.int64)))
                    place += count
                if out:
                    columns = list(zip(*out, strict=True))
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<long>"
    return (rows.select("start", "dict_sha256", "doc_ids", "offsets", "lengths", "counts", "frames")
            .mapInArrow(run, f"doc_id long, start long, n_tokens long, {kind}"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from a new store."""
    path = new_path(docs.sparkSession, "token-store")
    write(docs, path)
    return read(docs.sparkSession, path, digest=True)
