"""Repair of conversation structure by the auction algorithm for shortest paths.

A conversation's rows and the states of the wanted sequence of roles,
(s?(ua)+)?, span a lattice: a node is (rows read, state), an arc an edit with an
integer cost. The auction algorithm (Bertsekas) keeps a price per node and a
path that grows from the start: the path is extended along the cheapest arc
(cost and price of its head), or, if that is dearer than the price of its last
node, that price rises and the path contracts. When the path arrives, prices
differ along every shortest path by exactly the costs of its arcs: these tight
arcs, as far as they lead to the end, are traced in the order of the edits'
initials, which gives the least of the cheapest edit strings.

Rows are put in order by ranges over the whole table, not per conversation, and
worked on in chunks of CHUNK rows: a conversation of any length spans several
tasks. Per chunk the prices between its borders are found for each state at its
end; chunks of one conversation are joined by their 4 x 4 costs, first within a
task's range, then between ranges; the trace of a chunk follows from the prices
at its end. Every row ends with a letter of its own (Keep, Rerole, Delete) and
insertions stand before the row they precede, so the least string of the whole
is the least string in each chunk.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bancalyt.llm.common import materialize, workers_find_package

#: rows of a chunk, and bytes of its texts, at most (a longer text alone)
CHUNK = 32
CHUNK_BYTES = 1 << 20
#: characters by which texts of one turn and role are put in order, before their hashes
BEGINNING = 100
#: costs of the edits; an undeleted truncated row costs TRUNCATED more
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: states of the wanted sequence: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> state after a role's initial
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FAR = 1 << 40
#: symbols of truncated rows
CUT = "SUA_"

#: initials of neighbouring roles that may follow one another
LEGAL = ("su", "ua", "au")
_VISIBLE = r"[^\x20\x09-\x0D]"


# --- the lattice -----------------------------------------------------------------------------

def arcs_of(symbols: str, last: bool):
    """Arcs (cost, letter, target) of every node (row * 4 + state) of a chunk whose
    rows are ``symbols``: the role's initial (s, u, a, or - for another one; S, U, A
    or _ if the row is truncated), or x if it must go. ``last``: the rows end
    here, insertions may follow them."""
    out = []
    for i, symbol in enumerate([*symbols, None]):
        for state in range(4):
            arcs = []
            if symbol is not None or last:
                for role in "ua":
                    if (to := NEXT.get((state, role))) is not None:
                        arcs.append((INSERT, "I", 4 * i + to))
            if symbol is not None:
                arcs.append((DELETE, "D", 4 * (i + 1) + state))
                if symbol != "x":
                    more = TRUNCATED if symbol in CUT else 0
                    role = symbol.lower()
                    if (to := NEXT.get((state, role))) is not None:
                        arcs.append((more, "K", 4 * (i + 1) + to))
                    for other in "ua":
                        if other != role and (to := NEXT.get((state, other))) is not None:
                            arcs.append((REROLE + more, "R", 4 * (i + 1) + to))
            out.append(arcs)
    return out


def reaching(arcs, exits: dict[int, int]) -> set[int]:
    """The nodes from which arcs lead to the end."""
    back: dict[int, list[int]] = {}
    for node, out in enumerate(arcs):
        for _, _, head in out:
            back.setdefault(head, []).append(node)
    found, todo = set(exits), list(exits)
    while todo:
        for node in back.get(todo.pop(), ()):
            if node not in found:
                found.add(node)
                todo.append(node)
    return found


def auction(arcs, exits: dict[int, int], prices: list[int], start: int) -> None:
    """Raise ``prices`` until the price of ``start`` is its shortest distance to the
    end, through the nodes ``exits`` (node -> cost from there to the end, whose
    price is 0). Before and after, no price exceeds an arc's cost plus its head's
    price. Nodes that cannot reach the end have the price FAR; ``start`` can."""
    path = [start]
    while True:
        node = path[-1]
        least, to = exits.get(node, FAR), -1
        for cost, _, head in arcs[node]:
            if cost + prices[head] < least:
                least, to = cost + prices[head], head
        if prices[node] < least:
            prices[node] = least
            if len(path) > 1:
                path.pop()  # contract
        elif to < 0:
            return  # the end
        else:
            path.append(to)  # extend


@functools.lru_cache(maxsize=1 << 14)
def converged(symbols: str, last: bool, exits: tuple[int, ...]) -> tuple[int, ...]:
    """Prices of all nodes of a chunk after auctions from each state at its begin;
    ``exits``: the cost from each state at its end to the end of all."""
    arcs = arcs_of(symbols, last)
    ends = {4 * len(symbols) + s: c for s, c in enumerate(exits) if c < FAR}
    alive = reaching(arcs, ends)
    prices = [0 if node in alive else FAR for node in range(len(arcs))]
    for state in range(4):
        if state in alive:
            auction(arcs, ends, prices, state)
    return tuple(prices)


#: cost from each state after the last row: what must still be inserted
END = converged("", True, (0, FAR, FAR, 0))[:4]


def crossing(symbols: str) -> list[int]:
    """The 16 costs from each state before a chunk to each state after it."""
    costs = [converged(symbols, False, tuple(0 if s == end else FAR for s in range(4)))[:4] for end in range(4)]
    return [costs[end][begin] for begin in range(4) for end in range(4)]


@functools.lru_cache(maxsize=1 << 14)
def traced(symbols: str, last: bool, exits: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least cheapest edit string from ``state`` before the chunk, and the state
    after it: along tight arcs from which tight arcs lead on to the end."""
    arcs, prices = arcs_of(symbols, last), converged(symbols, last, exits)
    final = 4 * len(symbols)
    tight = [[(cost, letter, head) for cost, letter, head in out if prices[head] < FAR and prices[node] == cost + prices[head]] for node, out in enumerate(arcs)]
    alive = reaching(tight, {final + s: c for s, c in enumerate(exits) if c < FAR and prices[final + s] == c})
    node, letters = state, []
    # equal letters lead to one node: a state takes one inserted or rewritten role
    while node < final or prices[node] != exits[node - final]:
        _, letter, node = min((a for a in tight[node] if a[2] in alive), key=lambda a: a[1])
        letters.append(letter)
    return "".join(letters), node - final


def cost_of(symbols: str, edits: str) -> int:
    rows = iter(symbols)
    total = 0
    for edit in edits:
        if edit == "I":
            total += INSERT
            continue
        symbol = next(rows)
        total += DELETE if edit == "D" else (REROLE if edit == "R" else 0) + (TRUNCATED if symbol in CUT else 0)
    return total


def replay(symbols: str, roles: list[str], texts: list[str], edits: str, state: int):
    """The repaired rows (edit, role, text) of a chunk."""
    at = 0
    for edit in edits:
        if edit == "I":
            role = "a" if state == USER else "u"
            yield edit, ("assistant" if role == "a" else "user"), ""
            state = NEXT[state, role]
            continue
        if edit == "K":
            yield edit, roles[at], texts[at]
            state = NEXT[state, symbols[at].lower()]
        elif edit == "R":
            role = "a" if state == USER else "u"
            yield edit, ("assistant" if role == "a" else "user"), texts[at]
            state = NEXT[state, role]
        at += 1


# --- chunks of rows --------------------------------------------------------------------------

CHUNKS = ("conv string, part int, chunk int, alone boolean, symbols string, roles array<string>, texts array<string>, blank long, duplicate long, "
          "truncated long, illegal long, first string, last string, turns long, least long, most long, crossing array<long>")


def _table(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    schema = _table(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema.names)


def chunk_of(held: list[tuple], part: int, number: int, alone: bool) -> tuple:
    """The row of CHUNKS for rows (conv, turn, role, text, fault) in order."""
    faults = [r[4] for r in held]
    initials = [r[2][:1] for r in held]
    kinds = [i if i in ("s", "u", "a") else "-" for i in initials]
    symbols = "".join("x" if f in ("blank", "duplicate") else CUT["sua-".index(k)] if f else k for k, f in zip(kinds, faults, strict=True))
    turns = [r[1] for r in held if r[1] is not None]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return (held[0][0], part, number, alone, symbols, [r[2] for r in held], [r[3] for r in held], *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal,
            initials[0], initials[-1], len(set(turns)), min(turns, default=None), max(turns, default=None), None if alone else crossing(symbols))


def chunks(batches):
    """Rows in order -> a row per chunk of a conversation. Equal neighbours are
    copies of one row: all but the first are duplicates. ``alone``: the chunk is
    known to be its whole conversation."""
    part = TaskContext.get().partitionId()
    held: list[tuple] = []
    out: list[tuple] = []
    size = weight = number = 0
    before = None
    begun = False  # the first conversation of a range may have begun in another one
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "seen", "visible", "cut")]
        for conv, turn, role, text, seen, visible, cut in zip(*columns, strict=True):
            same = bool(held) and held[0][0] == conv
            if held and (not same or len(held) >= CHUNK or size + len(text) > CHUNK_BYTES):
                out.append(chunk_of(held, part, number, begun and number == 0 and not same))
                number, begun = (number + 1, begun) if same else (0, True)
                weight += size
                held, size = [], 0
                if weight > CHUNK_BYTES or len(out) >= 1000:
                    yield _batch(out, CHUNKS)
                    out, weight = [], 0
            row = (conv, turn, role, text)
            held.append((*row, "blank" if not visible else "duplicate" if seen or row == before else "truncated" if cut else ""))
            size += len(text)
            before = row
    if held:
        out.append(chunk_of(held, part, number, False))
    if out:
        yield _batch(out, CHUNKS)


def _join(first: list[int], second: list[int]) -> list[int]:
    """Costs through two neighbouring stretches."""
    return [min(min(first[4 * i + k] + second[4 * k + j] for k in range(4)), FAR) for i in range(4) for j in range(4)]


def _exits(costs: list[int], exits: list[int]) -> list[int]:
    return [min(min(costs[4 * i + j] + exits[j] for j in range(4)), FAR) for i in range(4)]


def _level(exits: list[int]) -> tuple[int, ...]:
    """Costs above the least of them: edits depend on nothing else."""
    least = min(exits)
    return tuple(c - least if c < FAR else FAR for c in exits)


def _border(before: dict | None, after: dict) -> tuple[int, int]:
    """Illegal neighbours, and turns counted twice, where two stretches meet."""
    if before is None:
        return 0, 0
    return int(before["last"] + after["first"] not in LEGAL), int(before["most"] is not None and before["most"] == after["least"])


PARTS = "conv string, part int, crossing array<long>, first string, last string, least long, most long"
EXITS = "conv string, part int, exits array<long>, illegal long, twice long"
STATES = "conv string, part int, chunk int, exits array<long>, entries array<long>, afters array<long>, final boolean, illegal long, twice long"
ENTRIES = "conv string, part int, entry int"


def _rows(table: pa.Table, *keys: str) -> list[dict]:
    return table.sort_by([(k, "ascending") for k in keys]).to_pylist()


def part_costs(table: pa.Table) -> pa.Table:
    """Chunks of a conversation in one range -> their costs as one stretch."""
    rows = _rows(table, "chunk")
    costs = functools.reduce(_join, (r["crossing"] for r in rows))
    turns = [r for r in rows if r["least"] is not None]
    row = (rows[0]["conv"], rows[0]["part"], costs, rows[0]["first"], rows[-1]["last"], turns[0]["least"] if turns else None, turns[-1]["most"] if turns else None)
    return pa.Table.from_batches([_batch([row], PARTS)])


def part_exits(table: pa.Table) -> pa.Table:
    """Ranges of a conversation, last first: the costs from their ends to the end."""
    rows, out, exits = _rows(table, "part"), [], list(END)
    for i in range(len(rows) - 1, -1, -1):
        out.append((rows[i]["conv"], rows[i]["part"], exits, *_border(rows[i - 1] if i else None, rows[i])))
        exits = _exits(rows[i]["crossing"], exits)
    return pa.Table.from_batches([_batch(out, EXITS)])


def chunk_states(table: pa.Table) -> pa.Table:
    """Chunks of a conversation in one range, with the costs at the range's end:
    the costs at each chunk's end, and for each state before the range the states
    before and after the chunk."""
    rows = _rows(table, "chunk")
    exits, ends = list(rows[0]["exits"]), []
    for r in reversed(rows):
        ends.append(exits)
        exits = _exits(r["crossing"], exits)
    states, out, before = list(range(4)), [], None
    for r, end in zip(rows, reversed(ends), strict=True):
        reach = _exits(r["crossing"], end)
        after = [traced(r["symbols"], False, _level(end), s)[1] if s >= 0 and reach[s] < FAR else -1 for s in states]
        out.append((r["conv"], r["part"], r["chunk"], end, states, after, r is rows[-1], *_border(before, r)))
        states, before = after, r
    return pa.Table.from_batches([_batch(out, STATES)])


def part_entries(table: pa.Table) -> pa.Table:
    """The state before each range of a conversation; ranges in order."""
    out, state = [], START
    for r in _rows(table, "part"):
        out.append((r["conv"], r["part"], state))
        state = r["afters"][state]
    return pa.Table.from_batches([_batch(out, ENTRIES)])


# --- the operator ----------------------------------------------------------------------------

def faulty(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, seen, visible, cut) from conv_id, turn, role, text:
    a key of the conversation, nulls in role and text as one space, whether role
    and text stand at an earlier turn, whether anything is visible, and whether the
    last visible character ends no sentence."""
    key = F.when(F.col("conv_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    rows = rows.select(key.alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7), "text", "role").alias("h2"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    # only what stands at several turns has an earlier one
    firsts = (rows.groupBy("conv", "h1", "h2").agg(F.min(when).alias("first"), F.max(when).alias("final")).where("first <> final")
              .select("conv", "h1", "h2", "first"))
    rows = rows.join(firsts, ["conv", "h1", "h2"], "left")
    visible = F.col("text").rlike(_VISIBLE)
    return rows.select("conv", "turn", "role", "text", "h1", "h2", F.coalesce(when > F.col("first"), F.lit(False)).alias("seen"), visible.alias("visible"),
                       (visible & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))


def planned(rows: DataFrame) -> DataFrame:
    """Chunks of all conversations (CHUNKS) with exits, entry, and what their borders
    add: illegal neighbours and turns counted twice. Written to the shared folder."""
    workers_find_package(rows.sparkSession)
    # the beginnings of texts, for the sampled cuts of the ranges go through the driver
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, BEGINNING), F.col("h1")]
    found = faulty(rows).repartitionByRange(*order).sortWithinPartitions(*order, "h2", "text")
    found = materialize(found.mapInArrow(chunks, CHUNKS), "chunks")
    small = found.where("not alone").drop("roles", "texts", "alone")
    parts = small.groupBy("conv", "part").applyInArrow(part_costs, PARTS)
    exits = materialize(parts.groupBy("conv").applyInArrow(part_exits, EXITS), "part-exits")
    ends = exits.select("conv", "part", "exits")
    states = small.select("conv", "part", "chunk", "symbols", "crossing", "first", "last", "least", "most").join(ends, ["conv", "part"])
    states = materialize(states.groupBy("conv", "part").applyInArrow(chunk_states, STATES), "chunk-states")
    entries = states.where("final").select("conv", "part", "afters").groupBy("conv").applyInArrow(part_entries, ENTRIES)
    entries = entries.join(exits.select("conv", "part", F.col("illegal").alias("more_illegal"), F.col("twice").alias("more_twice")), ["conv", "part"])
    first = F.col("chunk") == 0
    plan = states.join(entries, ["conv", "part"]).select(
        "conv", "part", "chunk", "exits", F.col("entries")[F.col("entry")].cast("int").alias("entry"),
        (F.col("illegal") + F.when(first, F.col("more_illegal")).otherwise(0)).alias("border_illegal"),
        (F.col("twice") + F.when(first, F.col("more_twice")).otherwise(0)).alias("border_twice"))
    plan = materialize(plan, "repair-plan")
    return found.drop("crossing").join(plan, ["conv", "part", "chunk"], "left")


def edited(row: dict) -> tuple[str, int, list[tuple[str, str, str]]]:
    """(edits, cost, repaired rows) of a planned chunk; the last one of a conversation
    (its exits are END) takes the insertions after the last row."""
    exits = END if row["exits"] is None else tuple(row["exits"])
    entry = START if row["entry"] is None else row["entry"]
    edits, after = traced(row["symbols"], False, _level(exits), entry)
    if row["ending"]:
        edits += traced("", True, (0, FAR, FAR, 0), after)[0]
    return edits, cost_of(row["symbols"], edits), list(replay(row["symbols"], row["roles"], row["texts"], edits, entry))


def _ending(plan: DataFrame) -> DataFrame:
    """``plan`` with the mark of each conversation's last chunk."""
    last = plan.where("not alone").groupBy("conv").agg(F.max(F.struct("part", "chunk")).alias("ender"))
    return plan.join(last, "conv", "left").withColumn("ending", F.col("alone") | (F.struct("part", "chunk") == F.col("ender"))).drop("ender")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows: conv_id (as text), part, chunk, at (in their order), edit,
    role, text."""
    schema = "conv string, part int, chunk int, at long, edit string, role string, text string"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, _, kept = edited(row)
                yield _batch([(row["conv"], row["part"], row["chunk"], i, *k) for i, k in enumerate(kept)], schema)

    out = _ending(planned(rows)).mapInArrow(run, schema)
    return out.select(F.when(F.col("conv") != "-", F.substring("conv", 2, 1 << 30)).alias("conv_id"), "part", "chunk", "at", "edit", "role", "text")


RESULTS = ("conv string, part int, chunk int, alone boolean, blank long, duplicate long, truncated long, illegal long, turns long, "
           "least long, most long, cost long, audit string, kept long, text string, hash string")


def _results(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            edits, cost, kept = edited(row)
            text = "\n".join(f"{role}:{text}" for _, role, text in kept)
            digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if row["alone"] else None
            out.append((row["conv"], row["part"], row["chunk"], row["alone"], row["blank"], row["duplicate"], row["truncated"],
                        row["illegal"] + (row["border_illegal"] or 0), row["turns"] - (row["border_twice"] or 0), row["least"], row["most"],
                        cost, edits, len(kept), None if row["alone"] else text, digest))
        yield _batch(out, RESULTS)


def _digests(batches):
    """(conv, audit, hash) of conversations of several chunks, which come in order:
    the hash takes a chunk at a time."""
    schema = "conv string, audit string, hash string"
    conv, letters, digest, begun = None, [], None, False
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["conv"] != conv:
                if conv is not None:
                    out.append((conv, "".join(letters), digest.hexdigest()))
                conv, letters, digest, begun = row["conv"], [], hashlib.sha256(), False
            letters.append(row["audit"])
            if row["kept"]:
                digest.update((b"\n" if begun else b"") + row["text"].encode("utf-8", "surrogatepass"))
                begun = True
        yield _batch(out, schema)
    if conv is not None:
        yield _batch([(conv, "".join(letters), digest.hexdigest())], schema)


def report(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conversation of ``originals`` (null: one of its own),
    from its rows in ``rows``; zeros, an empty audit and the hash of nothing where
    there are none.

    Rows stand by turn (nulls first), ties by role, then by the text's first
    BEGINNING characters, then by its hash; equal rows stand side by side. Nulls in role and text count as one space. Columns other
    than conv_id, turn, role and text are not read."""
    found = materialize(_ending(planned(rows)).mapInArrow(_results, RESULTS), "repairs")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("turns"), F.lit(0)).alias("gaps")
    numbers = found.groupBy("conv").agg(gaps, *sums)
    long = found.where("not alone").select("conv", "part", "chunk", "audit", "kept", "text").repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    strings = found.where("alone").select("conv", "audit", "hash").unionByName(long.mapInArrow(_digests, "conv string, audit string, hash string"))
    key = F.when(F.col("conv_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    every = originals.select("conv_id").distinct().withColumn("conv", key)
    joined = every.join(numbers, "conv", "left").join(strings, "conv", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("hash", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the contract's damage, by crc32 of
    ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its ends
    of sentences, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                                F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20)).alias("d")).where("d <> 0")
    text = F.when(F.col("d") == 1, F.lit("")).when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("d") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), "d")
    return rows.withColumn("d", F.explode(F.when(F.col("d") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("d")


#: the report over the damaged rows of ``{conversations}``, by dynamic programming over (rows read, state)
ORACLE = r"""
WITH RECURSIVE bits(i, v, k) AS (
  SELECT i, i, 0 FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM {conversations}
), hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS d FROM named, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS n FROM hashed WHERE d <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, n) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ending FROM damaged
), judged AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), numbers AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM judged GROUP BY conv_id
), inserted(s, letters, price, said, t) AS (
  VALUES ('0', '', 0, '', '0'), ('0', 'I', 5, chr(10) || 'user:', 'u'), ('0', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
         ('s', '', 0, '', 's'), ('s', 'I', 5, chr(10) || 'user:', 'u'), ('s', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
         ('u', '', 0, '', 'u'), ('u', 'I', 5, chr(10) || 'assistant:', 'a'), ('a', '', 0, '', 'a'), ('a', 'I', 5, chr(10) || 'user:', 'u')
), follows(s, r) AS (VALUES ('0', 's'), ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
edits AS (
  SELECT conv_id, i, 'D' AS letter, 2 AS price, '' AS said, s, s AS t FROM judged, (VALUES ('0'), ('s'), ('u'), ('a')) x(s)
  UNION ALL SELECT conv_id, i, 'K', CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, chr(10) || role || ':' || text, s, r FROM judged JOIN follows ON initial = r
    WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, 'R', CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, chr(10) || CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text, s, r
    FROM judged JOIN follows ON initial <> r WHERE r <> 's' AND fault NOT IN ('blank', 'duplicate')
), walked(conv_id, i, s, cost, audit, said) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '0', 0, '', '' FROM numbers
  UNION ALL
  SELECT conv_id, i, t, cost, audit, said FROM (
    SELECT w.conv_id, e.i, e.t, w.cost + x.price + e.price AS cost, w.audit || x.letters || e.letter AS audit, w.said || x.said || e.said AS said,
           row_number() OVER (PARTITION BY w.conv_id, e.t ORDER BY w.cost + x.price + e.price, w.audit || x.letters || e.letter) AS nth
    FROM walked w JOIN inserted x ON x.s = w.s JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.s = x.t
  ) WHERE nth = 1
), ended AS (
  SELECT n.conv_id, w.cost + x.price AS cost, w.audit || x.letters AS audit, w.said || x.said AS said
  FROM numbers n JOIN walked w ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.i = n.n JOIN inserted x ON x.s = w.s AND x.t IN ('0', 'a')
  QUALIFY row_number() OVER (PARTITION BY n.conv_id ORDER BY w.cost + x.price, w.audit || x.letters) = 1
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {conversations}) o LEFT JOIN numbers n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
