"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, one gadget after the other, into a deterministic
automaton over token labels that accepts exactly the tokenizations BPE makes.
At first one state has a loop for every base symbol. The gadget of the merge
(a, b) looks at the state that a leads to: if b leaves it, a is redirected to a
copy of that state without b, an arc ab is added wherever a leaves, and ab
leads where b led. So the target of an arc depends on its label alone, a state
differs from the one it was copied from by the arcs taken away, and an arc's
presence follows from the steps at which gadgets took arcs away: along the
label's chain of left parts (whose arcs it was added beside) and the state's
chain of right parts (whose states it was copied from).

Compiled are: a table of transitions (node, symbol) -> node over the symbols of
labels, the label that each node completes, and per label its parts and the steps
at which it was added and its arcs taken away. Many words are encoded at once, in
one forward pass over their positions: as every beginning of a word has one
tokenization, the state at a position is the last label of it; from there, each
label that the transitions read and whose arc leaves the state sets the state at
the position where it ends. Nothing is stepped back over. Presence of an arc is
read from the tables of gadgets and remembered in a table of fixed size (all arcs,
label by label, would be 2.4e9 entries). Decoding emits arc labels.
"""

from __future__ import annotations

import array
import functools
import hashlib
import itertools
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bancalyt.llm.common import WIDE_SPACE, Table, as_bytes, blocks, release_memory, taken, wide_space, workers_find_package
from bancalyt.llm.rolling import BYTE_VALUES, Prefix, join_texts, run_spans

TOKENIZER = "word_bpe_49k.json"
#: entries of a worker's tables: arcs (a power of two), runs (``rolling.run_spans``)
ARC_TABLE = 1 << 20
RUN_TABLE = 200_000
#: symbols of words that are encoded at once, each of at most SHORT symbols; longer
#: words go by themselves, in pieces of PIECE symbols
AT_ONCE = 1 << 18
SHORT = 40
PIECE = 1 << 16

#: Unicode white space as the tokenizers' patterns know it
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Automaton:
    """The compiled merges. ``labels`` maps token strings to ids, ``merges``
    lists pairs of strings by rank; a word's last symbol carries ``end``."""

    def __init__(self, labels: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        size = max(labels.values()) + 1
        self.size = size
        self.left = [-1] * size
        self.right = [-1] * size
        #: step of the gadget that added a label (0: base symbol)
        self.born = [0] * size
        #: (a, b) -> step at which b was taken away from the state a leads to
        self.taken: dict[int, int] = {}
        made = {a + b for a, b in merges}
        self.labels = {s: i for s, i in labels.items() if s not in made}
        for step, (a, b) in enumerate(merges, 1):
            x, y = self.labels.get(a), self.labels.get(b)
            if x is None or y is None or not self._leaves(x, y, step):
                continue  # no such path: the gadget changes nothing
            made_id = labels[a + b]
            self.left[made_id], self.right[made_id], self.born[made_id] = x, y, step
            self.taken[x * size + y] = step
            self.labels[a + b] = made_id
        self._compile(labels, end)

    def _compile(self, labels: dict[str, int], end: str) -> None:
        """Tables of the transitions, and of what the gadgets did."""
        letters = sorted({c for s in self.labels for c in s})
        self.letters = len(letters)
        #: code point -> symbol; a word's last symbol is ``letters`` further where words have an end
        self.symbol = np.full(0x110000, -1, np.int32)
        self.symbol[[ord(c) for c in letters]] = np.arange(len(letters))
        self.ended = len(letters) if end else 0
        self.symbols = len(letters) + self.ended
        number = {c: i for i, c in enumerate(letters)}
        nodes: dict[int, int] = {}
        completes = {}
        for text, label in self.labels.items():
            whole = end and len(text) > len(end) and text.endswith(end)
            path = [number[c] for c in (text[:-len(end)] if whole else text)]
            if whole:
                path[-1] += self.ended
            if len(path) > 1 and not self.born[label]:
                continue  # neither a symbol nor made by a gadget
            node = 0
            for x in path:
                node = nodes.setdefault(node * self.symbols + x, len(nodes) + 1)
            completes[node] = label
        self.moves = np.array(sorted(nodes), np.int64)
        self.targets = np.array([nodes[k] for k in self.moves.tolist()], np.int64)
        self.completes = np.full(len(nodes) + 1, -1, np.int64)
        self.completes[list(completes)] = list(completes.values())
        self.left_of, self.right_of, self.born_at = (np.array(x, np.int64) for x in (self.left, self.right, self.born))
        self.taken_keys = np.array(sorted(self.taken), np.int64)
        self.taken_steps = np.array([self.taken[k] for k in self.taken_keys.tolist()], np.int64)
        #: (state, label, whether its arc leaves) of one arc a slot
        self.known = np.full(ARC_TABLE, -1, np.int64)

    def _leaves(self, x: int, y: int, before: int) -> bool:
        """Whether the arc y leaves the state that x leads to, as of the gadgets
        before step ``before``."""
        size, taken, born = self.size, self.taken, self.born
        while True:
            state, upper = x, before
            while state >= 0:
                step = taken.get(state * size + y)
                if step is not None and step < upper:
                    return False
                upper = min(upper, born[state])  # this state was copied from its right part's at that step
                state = self.right[state]
            if not born[y]:
                return True
            # the arc was added beside its left part's, after that gadget took its own away
            before = min(before, born[y] + 1)
            y = self.left[y]

    def _leave(self, keys: np.ndarray) -> np.ndarray:
        """``_leaves`` after all gadgets, of many arcs (state * size + label) at once."""
        out = np.ones(len(keys), bool)
        if not len(self.taken_keys):
            return out
        x, y = np.divmod(keys, self.size)
        before, rows = np.full(len(keys), np.int64(1) << 62), np.arange(len(keys))
        while len(rows):
            at, state, upper = rows, x[rows], before[rows]
            while len(at):
                place = state * self.size + y[at]
                found = np.searchsorted(self.taken_keys, place).clip(max=len(self.taken_keys) - 1)
                gone = (self.taken_keys[found] == place) & (self.taken_steps[found] < upper)
                out[at[gone]] = False
                upper, state = np.minimum(upper, self.born_at[state]), self.right_of[state]
                more = (state >= 0) & ~gone
                at, state, upper = at[more], state[more], upper[more]
            rows = rows[out[rows] & (self.born_at[y[rows]] > 0)]
            before[rows] = np.minimum(before[rows], self.born_at[y[rows]] + 1)
            y[rows] = self.left_of[y[rows]]
        return out

    def arcs(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Whether the arcs leave; from the start state (-1) all do."""
        keys = states * self.size + labels
        slots = ((keys * 0x9E3779B1) >> 12) & (ARC_TABLE - 1)
        held = self.known[slots]
        out = (held & 1).astype(bool)
        new = (held >> 1 != keys) & (states >= 0)
        if new.any():
            some, back = np.unique(keys[new], return_inverse=True)
            leaves = self._leave(some)
            self.known[((some * 0x9E3779B1) >> 12) & (ARC_TABLE - 1)] = some * 2 + leaves
            out[new] = leaves[back]
        return out | (states < 0)

    def _read(self, symbols: np.ndarray, stops: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, label) of all labels that begin at the first ``count``
        positions of ``symbols`` and end with their word, at ``stops``, or before."""
        start, node, length = np.arange(count), np.zeros(count, np.int64), 0
        found = []
        while len(start) and len(self.moves):
            key = node * self.symbols + symbols[start + length]
            move = np.searchsorted(self.moves, key).clip(max=len(self.moves) - 1)
            goes = (self.moves[move] == key) & (symbols[start + length] >= 0)
            start, node, length = start[goes], self.targets[move[goes]], length + 1
            label = self.completes[node]
            ends = label >= 0
            found.append((start[ends], np.full(int(ends.sum()), length), label[ends]))
            inner = start + length < stops[start]
            start, node = start[inner], node[inner]
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def _symbols(self, words: list[str], stops: np.ndarray) -> np.ndarray:
        if not len(symbols := np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)):
            return np.zeros(0, np.int64)
        symbols = self.symbol[symbols].astype(np.int64)
        last = stops - 1
        symbols[last] += np.where(symbols[last] >= 0, self.ended, 0)
        return symbols

    def encode_all(self, words: list[str]) -> list[list[int]]:
        """Token ids of every word."""
        return [np.frombuffer(ids, "<i4").tolist() for ids in self.packed(words)]

    def packed(self, words: list[str]) -> list[bytes]:
        """Token ids of every word, as little-endian 32-bit integers."""
        out: list = [None] * len(words)
        some, total = [], 0
        for i, word in enumerate(words):
            if not word:
                out[i] = b""
                continue
            if len(word) > SHORT:
                out[i] = np.array(self._encode_long(word), "<i4").tobytes()
                continue
            if total + len(word) > AT_ONCE:
                self._encode_short(words, some, out)
                some, total = [], 0
            some.append(i)
            total += len(word)
        self._encode_short(words, some, out)
        return out

    def _encode_short(self, words: list[str], some: list[int], out: list) -> None:
        """One pass over the positions of all words ``some`` at once. A word has a
        place for each position and one for its end, all in one array."""
        if not some:
            return
        held = [words[i] for i in some]
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        stops = np.cumsum(sizes)
        begins = stops - sizes
        row_of = np.repeat(np.arange(len(held)), sizes)
        start, length, label = self._read(self._symbols(held, stops), stops[row_of], int(stops[-1]))
        row = row_of[start]
        inside = (start - begins[row]).astype(np.int16)
        order = np.argsort(inside, kind="stable")
        place = (start + row)[order]
        length, label = length[order], label[order]
        opens = begins + np.arange(len(held))
        state = np.full(int(stops[-1]) + len(held), -2, np.int64)  # no label ends here (yet)
        before = np.zeros(len(state), np.int64)
        state[opens] = -1
        cuts = np.searchsorted(inside[order], np.arange(int(sizes.max()) + 2))
        for a, b in itertools.pairwise(cuts.tolist()):
            here = state[place[a:b]]
            reached = np.flatnonzero(here != -2)
            reached = a + reached[self.arcs(here[reached], label[a:b][reached])]
            to = place[reached] + length[reached]
            state[to] = label[reached]
            before[to] = place[reached]
        at = opens + sizes
        if (state[at] == -2).any():
            raise ValueError(f"no tokens for {held[int((state[at] == -2).argmax())]!r}")
        ends = np.zeros(len(state), bool)
        while len(at):
            ends[at] = True
            at = before[at]
            at = at[state[at] != -1]
        data = state[ends].astype("<i4").tobytes()
        cuts = (4 * np.cumsum(np.add.reduceat(ends, opens, dtype=np.int64))).tolist()
        for i, a, b in zip(some, [0, *cuts], cuts, strict=False):
            out[i] = data[a:b]

    def _encode_long(self, word: str) -> list[int]:
        """The same pass over one word, piece by piece."""
        n = len(word)
        symbols = self._symbols([word], np.array([n]))
        state, before = array.array("i", [-2]) * (n + 1), array.array("i", [0]) * (n + 1)
        state[0] = -1
        arcs: dict[tuple[int, int], bool] = {}
        for begin in range(0, n, PIECE):
            count = min(PIECE, n - begin)
            start, length, label = self._read(symbols[begin:], np.full(count, n - begin), count)
            order = np.argsort(start, kind="stable")
            for at, size, x in zip((start[order] + begin).tolist(), length[order].tolist(), label[order].tolist(), strict=True):
                here = state[at]
                if here == -2:
                    continue
                leaves = arcs.get((here, x))
                if leaves is None:
                    if len(arcs) >= PIECE:
                        arcs.clear()
                    leaves = arcs[here, x] = here < 0 or self._leaves(here, x, 1 << 62)
                if leaves:
                    state[at + size], before[at + size] = x, at
        if state[n] == -2:
            raise ValueError(f"no tokens for {word!r}")
        ids, at = [], n
        while at:
            ids.append(state[at])
            at = before[at]
        return ids[::-1]


#: below this code point, runs are lower-cased and split here, where Python and
#: the library agree; others go through the library's normalizer and splitter
PLAIN = 0x180


def _plain_pattern(pattern: str) -> re.Pattern:
    """The file's split pattern for code points below PLAIN, its Unicode classes
    spelled out."""
    kind = {k: "".join(re.escape(chr(c)) for c in range(PLAIN) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    return re.compile(pattern.replace("[\\p{L}]", f"[{kind['L']}]").replace("[\\p{N}]", f"[{kind['N']}]")
                      .replace("[^\\s\\p{L}\\p{N}]", f"[^{SPACE}{kind['L']}{kind['N']}]"))


def _byte_symbols() -> list[str]:
    """The symbol of each byte in byte-level vocabularies: itself if it can be
    seen, the others in order from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return [chr(b) if b in set(seen) else chr(0x100 + hidden.index(b)) for b in range(256)]


class Tokenizer:
    """A tokenizer file with word-end BPE: its own normalizer and word pattern,
    and the automaton of its merges. White space is dropped by its pattern, and
    a mark after a letter begins a word in any case, so that each run between them
    can be encoded on its own."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, self.end)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.arc_labels = {i: s for s, i in {**model["vocab"], **added}.items()}
        self.added = {t.encode(): np.array([i], "<i4").tobytes() for t, i in added.items()}
        self.added_pattern = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")") if added else None
        self.runs = Table(RUN_TABLE)
        held = range(max(self.arc_labels) + 1)
        #: of each id: its label in UTF-8, and its decimal digits, with one space behind
        self.label_bytes = pa.array([f"{self.arc_labels.get(i, '')} ".encode() for i in held], pa.large_binary())
        self.decimals = pa.array([f"{i} ".encode() for i in held], pa.large_binary())
        self.symbols = _byte_symbols()
        split = [x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        self.plain_pattern = _plain_pattern(split[0])
        self.line_pattern = re.compile(self.plain_pattern.pattern + "|\n")

    def forget(self) -> None:
        """Give the table of runs back: a worker that waits holds the merges alone."""
        self.runs = Table(RUN_TABLE)
        release_memory()

    def _spell(self, word: str) -> str:
        """A word in byte symbols."""
        return word if word.isascii() and word.isprintable() else "".join([self.symbols[b] for b in word.encode()])

    def _split(self, runs: list[str]) -> tuple[list[str], list[str]]:
        """The words of all runs, "\n" after each run, as found; and in byte symbols.

        No word holds white space, so that plain runs are lower-cased and split
        many at once, a line for each."""
        plain, other = [], []
        for run in runs:
            fits = run.isascii() or max(run) < chr(PLAIN) and unicodedata.is_normalized("NFC", run)
            (plain if fits else other).append(run)
        found = self.line_pattern.findall("\n".join([*plain, ""]).lower())
        spelt = {w: self._spell(w) for w in set(found)}
        spelt["\n"] = "\n"
        words = list(map(spelt.__getitem__, found))
        for run in other:
            words += [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(run))]
            words.append("\n")
        return [*plain, *other], words

    def _encode_runs(self, runs: list[bytes]) -> list[bytes]:
        order, words = self._split([r.decode() for r in runs])
        distinct = list({*words} - {"\n"})
        ids = dict(zip(distinct, self.automaton.packed(distinct), strict=True))
        ids["\n"] = b"\xff\xff\xff\xff"  # no id
        data = b"".join(map(ids.__getitem__, words))
        cuts = (4 * np.flatnonzero(np.frombuffer(data, "<i4") == -1)).tolist()
        out = {r: data[a:b] for r, a, b in zip(order, [0, *(c + 4 for c in cuts)], cuts, strict=False)}
        return [out[r.decode()] for r in runs]

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        """Texts without added tokens. The runs of all texts are told apart by
        rolling hashes; each distinct one is looked up, or encoded if new."""
        data, begin, _ = join_texts([WIDE_SPACE.sub(b" ", t) if wide_space(t) else t for t in texts])
        starts, stops = run_spans(data)
        if not len(starts):
            return [b""] * len(texts)
        _, first, which = np.unique(Prefix(BYTE_VALUES[data]).hashes(starts, stops), return_index=True, return_inverse=True)
        joined = data.tobytes()
        runs = [joined[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        found = self.runs.values(runs, self._encode_runs)
        ids, ends = taken(pa.array(found, pa.large_binary()), which)
        cut = ends[np.searchsorted(starts, np.append(begin, len(data)))].tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """Token ids of every text in UTF-8, as little-endian 32-bit integers;
        what is new in the texts is encoded together."""
        added = self.added
        parts = [self.added_pattern.split(t) if any(a in t for a in added) else [t] for t in texts]
        ids = iter(self._encode_plain([p for x in parts for p in x[::2]]))
        return [next(ids) if len(x) == 1 else b"".join([added[p] if i % 2 else next(ids) for i, p in enumerate(x)]) for x in parts]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Token ids of every text."""
        return [np.frombuffer(ids, "<i4").tolist() for ids in self.packed([t.encode() for t in texts])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def spelt(self, ids: np.ndarray, cuts: np.ndarray, words: pa.Array) -> list[bytes]:
        """Of the ids of each text (all in one array, parted at ``cuts``) what
        ``words`` (label_bytes, decimals) holds for them, one space between."""
        data, ends = taken(words, ids)
        cut = ends[cuts].tolist()
        return [data[a:max(a, b - 1)] for a, b in zip(cut, cut[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        """The labels, with one space between them (the file names no decoder)."""
        labels = self.arc_labels
        return " ".join([labels[i] for i in ids])


@functools.lru_cache(maxsize=2)
def load(name: str) -> Tokenizer:
    """The tokenizer of a file: a path, or a name that public_tokenizers knows."""
    if not os.path.exists(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer(name)


def _flat(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in one array, and where each text's begin (one entry more)."""
    return np.frombuffer(b"".join(packed), "<i4"), np.cumsum([0, *(len(x) // 4 for x in packed)])


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, carry: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """The columns ``carry`` (default: doc_id) with n_tokens and ids, and with
    ``decoded`` what the ids decode to.

    One row per row; a null or empty text has no ids."""
    workers_find_package(docs.sparkSession)
    carry = ["doc_id"] if carry is None else carry
    held = docs.select(*[docs[c].alias(f"_c{i}") for i, c in enumerate(carry)], docs["text"].alias("_text"))

    def run(batches):
        own = load(tokenizer)
        for batch in blocks(batches, "_text"):
            ids, cuts = _flat(own.packed(as_bytes(batch.column("_text"))))
            back = [pa.array(own.spelt(ids, cuts, own.label_bytes), pa.binary()).cast(pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(carry))), pa.array(np.diff(cuts)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids)), *back],
                [*(f"_c{i}" for i in range(len(carry))), *names])
        own.forget()

    names = ["n_tokens", "ids", *["decoded"] * decoded]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema if f.name != "_text")
    out = held.mapInArrow(run, f"{types}, n_tokens long, ids array<int>" + ", decoded string" * decoded)
    return out.select(*[out[f"_c{i}"].alias(c) for i, c in enumerate(carry)], *names)


def decode(rows: DataFrame, tokenizer: str = TOKENIZER, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: doc_id) with the text of ``ids``; null ids: empty."""
    workers_find_package(rows.sparkSession)
    carry = ["doc_id"] if carry is None else carry
    held = rows.select(*[rows[c].alias(f"_c{i}") for i, c in enumerate(carry)], rows["ids"].alias("_ids"))

    def run(batches):
        own = load(tokenizer)
        for batch in batches:
            texts = [own.decode(ids or []) for ids in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(carry))), pa.array(texts, pa.string())],
                                             [*(f"_c{i}" for i in range(len(carry))), "decoded"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema if f.name != "_ids")
    out = held.mapInArrow(run, f"{types}, decoded string")
    return out.select(*[out[f"_c{i}"].alias(c) for i, c in enumerate(carry)], "decoded")


def report(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of every row."""
    workers_find_package(docs.sparkSession)

    def run(batches):
        own = load(tokenizer)
        digests = lambda texts: pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
        for batch in blocks(batches, "text"):
            ids, cuts = _flat(own.packed(as_bytes(batch.column("text"))))
            first, second = (digests(own.spelt(ids, cuts, words)) for words in (own.decimals, own.label_bytes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(cuts)), first, second],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        own.forget()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
