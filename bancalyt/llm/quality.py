"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Rolling hashes of several n-gram lengths are taken over the words of a block
of documents at once; an n-gram that its document has held before marks all its
words, and the rule compares the marked characters with all characters in
words. The first time is not marked, as in the published rules that the
limits follow; only the base rule on 5-word windows counts it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bancalyt.llm.common import as_bytes, blocks, workers_find_package
from bancalyt.llm.rolling import Prefix, join_texts, mix, words_of

#: n-gram length -> largest part of the characters inside n-grams held before
GRAM_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
#: largest part of the characters that stand in lines equal to an earlier one
LINE_LIMIT = 0.20
MIN_WORDS = 10
#: largest part of the words inside duplicated 5-word windows (base rule)
REPEAT_WORDS = 0.20
BASE_WINDOW = 5

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_chars long, " + ", ".join(f"dup_chars_{n} long" for n in GRAM_LIMITS) + ", base_failed boolean, kept boolean")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])


def _chars(data: bytes) -> int:
    """Code points of the words in UTF-8 ``data``."""
    return len(data.translate(None, _SEPARATORS).decode("utf-8", "replace"))


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier one, and the characters in their words."""
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0, 0
    seen: set[bytes] = set()
    count = chars = 0
    for line in lines:
        if line in seen:
            count += 1
            chars += _chars(line)
        elif line.translate(None, _SEPARATORS):
            seen.add(line)
    return count, chars


def _duplicated(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words stand inside an n-gram that their document holds twice or
    more: any time, and any but the first time."""
    if len(hashes) < n:
        return (np.zeros(len(hashes), bool),) * 2
    grams = Prefix(hashes).grams(n)
    at = np.flatnonzero(owner[:len(grams)] == owner[n - 1:])
    grams = grams[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(1))
    ordered = np.sort(grams)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return (np.zeros(len(hashes), bool),) * 2
    place = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    hit = np.flatnonzero(twice[place] == grams)
    again = np.ones(len(hit), bool)
    again[np.unique(grams[hit], return_index=True)[1]] = False

    def covered(begin):
        step = np.zeros(len(hashes) + 1, np.int32)
        step[begin] += 1
        step[begin + n] -= 1
        return np.cumsum(step[:-1]) > 0

    return covered(at[hit]), covered(at[hit[again]])


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of SCHEMA for a block of texts."""
    data, begin, end = join_texts(texts)
    first, last, hashes, owner, _ = words_of(texts)
    count = len(texts)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[last] - points[first]
    per_text = lambda values: np.bincount(owner, values, count).astype(np.int64)
    out = {"n_words": np.bincount(owner, minlength=count).astype(np.int64), "word_chars": per_text(chars)}
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["n_symbols"] = (marks[end] - marks[begin]).astype(np.int64)
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 2)
    out["n_dup_lines"] = lines[:, 0]
    inside = {n: _duplicated(hashes, owner, n) for n in {BASE_WINDOW, *GRAM_LIMITS}}
    out["n_repeat_words"] = per_text(inside[BASE_WINDOW][0])
    out["dup_line_chars"] = lines[:, 1]
    for n in GRAM_LIMITS:
        out[f"dup_chars_{n}"] = per_text(inside[n][1] * chars)
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > round(100 * REPEAT_WORDS) * out["n_words"])
    bad = out["base_failed"] | (100 * lines[:, 1] > round(100 * LINE_LIMIT) * out["word_chars"])
    for n, limit in GRAM_LIMITS.items():
        bad |= 100 * out[f"dup_chars_{n}"] > round(100 * limit) * out["word_chars"]
    out["kept"] = ~bad
    return out


def assess(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: doc_id) with the measures and verdict.

    One row per row of ``docs``, repeated rows and null ids included; a null or
    empty text has no words and fails the base rule."""
    workers_find_package(docs.sparkSession)
    carry = ["doc_id"] if carry is None else carry
    held = docs.select(*[docs[c].alias(f"_c{i}") for i, c in enumerate(carry)], docs["text"].alias("_text"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        for batch in blocks(batches, "_text"):
            found = measure(as_bytes(batch.column("_text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"_c{i}") for i in range(len(carry))), *(pa.array(found[n]) for n in names)],
                [*(f"_c{i}" for i in range(len(carry))), *(f"_q_{n}" for n in names)])

    types = {f.name: f.dataType.simpleString() for f in held.schema}
    schema = ", ".join([*(f"_c{i} {types[f'_c{i}']}" for i in range(len(carry))), *(f"_q_{x}" for x in SCHEMA.split(", "))])
    return held.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id with every measure and the verdict."""
    found = assess(docs)
    return found.select(found["_c0"].alias("doc_id"), *[found[f"_q_{n}"].alias(n) for n in (x.split()[0] for x in SCHEMA.split(", "))])


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    columns = docs.columns
    found = assess(docs, columns).where("_q_kept")
    return found.select(*[found[f"_c{i}"].alias(c) for i, c in enumerate(columns)])


def _gram_sql(n: int) -> str:
    """Whether each word stands inside a duplicated n-gram (any time: r{n}; any
    but the first time: a{n})."""
    gram = " || ' ' || ".join("word" if i == 0 else f"lead(word, {i}) OVER d" for i in range(n))
    over = f"OVER (PARTITION BY id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (f"g{n} AS (SELECT id, i, {gram} AS g FROM words WINDOW d AS (PARTITION BY id ORDER BY i)), "
            f"c{n} AS (SELECT id, i, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY id, g) > 1 THEN 1 ELSE 0 END AS dup, "
            f"CASE WHEN g IS NOT NULL AND row_number() OVER (PARTITION BY id, g ORDER BY i) > 1 THEN 1 ELSE 0 END AS again FROM g{n}), "
            f"r{n} AS (SELECT id, i, max(dup) {over} AS r{n}, max(again) {over} AS a{n} FROM c{n})")


def oracle(source: str) -> str:
    grams = sorted(GRAM_LIMITS)
    sep = "[\\x20\\x09-\\x0D]+"
    joins = " ".join(f"JOIN r{n} USING (id, i)" for n in grams)
    sums = ", ".join(f"CAST(sum(a{n} * len(word)) AS BIGINT) AS dup_chars_{n}" for n in grams)
    zero = lambda c: f"coalesce({c}, 0)"
    over = " OR ".join([f"100 * {zero('dup_line_chars')} > {round(100 * LINE_LIMIT)} * {zero('word_chars')}",
                        *(f"100 * {zero(f'dup_chars_{n}')} > {round(100 * GRAM_LIMITS[n])} * {zero('word_chars')}" for n in grams)])
    base = f"{zero('n_words')} < {MIN_WORDS} OR 100 * {zero('n_repeat_words')} > {round(100 * REPEAT_WORDS)} * {zero('n_words')}"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM {source}),
split AS (SELECT id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs),
words AS (SELECT id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM split),
{", ".join(_gram_sql(n) for n in grams)},
per AS (SELECT id, count(*) AS n_words, CAST(sum(len(word)) AS BIGINT) AS word_chars, CAST(sum(r{BASE_WINDOW}) AS BIGINT) AS n_repeat_words, {sums} FROM words {joins} GROUP BY id),
cut AS (SELECT id, string_split(text, chr(10)) AS ls FROM docs),
lines AS (SELECT id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM cut),
bare AS (SELECT id, line, len(regexp_replace(line, '{sep}', '', 'g')) AS chars, row_number() OVER (PARTITION BY id, line ORDER BY i) AS nth FROM lines),
dups AS (SELECT id, count(*) AS n_dup_lines, CAST(sum(chars) AS BIGINT) AS dup_line_chars FROM bare WHERE nth > 1 AND chars > 0 GROUP BY id)
SELECT doc_id, {zero('n_words')} AS n_words, {zero('word_chars')} AS word_chars,
  CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  {zero('n_dup_lines')} AS n_dup_lines, {zero('n_repeat_words')} AS n_repeat_words, {zero('dup_line_chars')} AS dup_line_chars,
  {", ".join(f"{zero(f'dup_chars_{n}')} AS dup_chars_{n}" for n in GRAM_LIMITS)},
  ({base}) AS base_failed, NOT ({base} OR {over}) AS kept
FROM docs LEFT JOIN per USING (id) LEFT JOIN dups USING (id)
"""
