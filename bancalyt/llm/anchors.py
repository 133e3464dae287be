"""Which windows may recur: anchors of windows, their keys, and the keys met twice.

Every window of fixed length has an anchor, a place inside it that depends on
the window's content alone (``rolling.window_anchors``), with a stretch after
it that lies in every window of that anchor. The hash of this stretch is the
anchor's key. Equal windows have equal keys, so a key that occurs once rules
all windows of its anchor out; few rows are sent on (about two per 200
windows), and no key is ever gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.common import doc_key, materialize, release_memory

#: rows of a batch that is sent back to the JVM
SLICE = 500
#: occurrences of a key beyond which its windows are counted by their hashes
#: over all tasks, instead of being brought together
HOT = 20_000


def second_key() -> Column:
    """64 further bits that tell rows apart where their texts or spans meet."""
    return F.xxhash64(F.lit(7), F.col("text"), F.col("doc_id"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the two 64-bit keys of a row; repeated rows share them."""
    return docs.select("doc_id", "text", doc_key().alias("dk"), second_key().alias("dk2"))


@dataclass
class Recurring:
    #: (dk, cold, hot, home, copies): per row key the ascending places of anchors
    #: whose key recurs, the smallest cold key and how often it occurs
    places: DataFrame
    #: recurring anchors whose key is cold, and those whose key is hot
    cold: int
    hot: int
    #: (key, n) of every key that occurs twice or more
    counts: DataFrame


def recurring(anchors: DataFrame, hot: int = HOT) -> Recurring:
    """From (key, dk, at) of all anchors, written once by the caller."""
    counts = materialize(anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "recurring-keys")
    found = anchors.select("key", "dk", "at").join(counts, "key")
    places = found.groupBy("dk").agg(
        F.sort_array(F.collect_set(F.when(F.col("n") <= hot, F.col("at")))).alias("cold"),
        F.sort_array(F.collect_set(F.when(F.col("n") > hot, F.col("at")))).alias("hot"),
        F.min(F.when(F.col("n") <= hot, F.struct("key", "n"))).alias("least"))
    places = places.select("dk", "cold", "hot", F.col("least.key").alias("home"), F.col("least.n").alias("copies"))
    places = materialize(places, "recurring-places")
    total = counts.agg(F.coalesce(F.sum(F.when(F.col("n") <= hot, F.col("n"))), F.lit(0)).alias("c"),
                       F.coalesce(F.sum(F.when(F.col("n") > hot, F.col("n"))), F.lit(0)).alias("h")).first()
    return Recurring(places, total.c, total.h, counts)


def counted_windows(windows: DataFrame) -> DataFrame:
    """(dk, dk2, begin) of those windows (h1, h2, dk, dk2, begin) whose 128-bit
    hash occurs twice or more: counts are pre-aggregated per task, and the join
    splits a hot hash."""
    windows = materialize(windows, "hot-windows")
    twice = materialize(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"), "hot-twice")
    return windows.join(twice, ["h1", "h2"], "left_semi").select("dk", "dk2", "begin")


class Sieve:
    """A fixed-size bitmap of row keys, by which texts are told apart before a
    join shuffles them: a row whose bit is unset has no partner. Its size is
    bounded (8 MB) whatever the data's; where it fills up, more rows without
    a partner go through the join, and the result stays the same."""

    BITS = 1 << 26

    def __init__(self, keys: DataFrame):
        slot = F.pmod(F.col("dk"), F.lit(self.BITS))
        words = (keys.select(slot.alias("s")).groupBy(F.shiftright("s", 6).cast("int").alias("w"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b")).toArrow())
        bits = np.zeros(self.BITS // 64, np.uint64)
        bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
        self.bits = keys.sparkSession.sparkContext.broadcast(bits)

    def split(self, rows: DataFrame, listed: bool, then=None, schema=None) -> DataFrame:
        """The rows (with a column dk) whose bit is set, or those whose bit is not;
        ``then`` maps their batches on in the same Python worker."""
        bits, size = self.bits, self.BITS

        def keep(batches):
            for batch in batches:
                slot = np.mod(batch.column(batch.schema.get_field_index("dk")).to_numpy(), size)
                held = pa.array((bits.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == int(listed))
                for i in range(0, batch.num_rows, SLICE):  # small batches on the way back
                    yield batch.slice(i, SLICE).filter(held.slice(i, SLICE))
                release_memory()

        if then is None:
            return rows.mapInArrow(keep, rows.schema)
        return rows.mapInArrow(lambda batches: then(keep(batches)), schema)


def with_spans(docs: DataFrame, spans: DataFrame, then=None, schema=None, name: str = "_spans") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that may have spans, joined with their spans (column
    ``name``, which ``docs`` lacks; null where there are none), and the others; from
    (dk, dk2, spans). ``then`` maps the batches of both."""
    sieve = Sieve(spans)
    columns = docs.columns
    names = [f"_c{i}" for i in range(len(columns))]
    rows = docs.select(doc_key().alias("dk"), second_key().alias("dk2"), *[docs[c].alias(n) for c, n in zip(columns, names, strict=True)])
    back = [F.col(n).alias(c) for c, n in zip(columns, names, strict=True)]
    joined = sieve.split(rows, True).join(spans.select("dk", "dk2", F.col("spans").alias("_s")), ["dk", "dk2"], "left").select(*back, F.col("_s").alias(name))
    if then is None:
        return joined, sieve.split(rows, False).select(*back)

    def named(batches):
        yield from then(pa.RecordBatch.from_arrays(batch.columns[2:], columns) for batch in batches)

    return joined.mapInArrow(then, schema), sieve.split(rows, False, named, schema)
