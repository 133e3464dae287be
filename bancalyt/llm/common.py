"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a word of every contract: a run of anything but space, tab, line ends, VT and FF
WORD = r"[^\x20\x09-\x0D]+"
#: bytes of text that one numpy pass works on
BLOCK_BYTES = 1 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did
    (a cluster without that path ships the package with --py-files)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the one that
    the session was given by ``setCheckpointDir``.

    Only a local session (tests) that names none gets a scratch folder; on a
    cluster each executor would write to its own disk."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="bancalyt-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: later passes and retried tasks read the same rows."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str = "_spans") -> str:
    """``name``, longer by underscores until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def doc_key() -> Column:
    """A 64-bit key of a row (id and text), equal for repeated rows; null-safe."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


#: white space beyond ASCII, and bytes without which a text has none of it
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_WIDE_LEADS = (b"\xc2", b"\xe1", b"\xe2", b"\xe3")


def wide_space(text: bytes) -> bool:
    """Whether a text in UTF-8 has white space beyond ASCII."""
    return any(x in text for x in _WIDE_LEADS) and WIDE_SPACE.search(text) is not None


def taken(values: pa.Array, which: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ``values`` (large_binary) numbered ``which`` end to end, and where each
    begins (one entry more)."""
    if not len(which):
        return b"", np.zeros(1, np.int64)
    some = values.take(pa.array(which))
    _, ends, data = some.buffers()
    ends = np.frombuffer(ends, np.int64, len(some) + 1, 8 * some.offset)
    return b"" if data is None else data.to_pybytes(), ends


def release_memory() -> None:
    """Give freed memory back to the system: workers stay alive between tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every libc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Table:
    """A bounded memo of two generations: when the recent one is full it becomes
    the past one, from which entries that are met again come back."""

    def __init__(self, size: int):
        self.size = size
        self.recent: dict = {}
        self.past: dict = {}

    def holding(self, keys: set, make) -> dict:
        """The recent generation, with all of ``keys``; ``make`` maps a list of
        unknown keys to their values (none of them None)."""
        new = keys.difference(self.recent)
        if new:
            known = {k: v for k in new if (v := self.past.get(k)) is not None}
            missing = [k for k in new if k not in known]
            known.update(zip(missing, make(missing), strict=True))
            if len(self.recent) + len(known) > self.size:
                self.past, self.recent = self.recent, {k: v for k in keys if (v := self.recent.get(k)) is not None}
            self.recent.update(known)
        return self.recent

    def values(self, keys: list, make) -> list:
        """The value of each of ``keys``; ``make`` as in ``holding``."""
        found = list(map(self.recent.get, keys))
        if None in found:
            table = self.holding({k for k, f in zip(keys, found, strict=True) if f is None}, make)
            found = [table[k] if f is None else f for k, f in zip(keys, found, strict=True)]
        return found


def blocks(batches, column: str, limit: int = BLOCK_BYTES):
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of
    ``column`` (a longer single text is a piece of its own)."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < len(sizes):
            yield batch.slice(begin)
        release_memory()
