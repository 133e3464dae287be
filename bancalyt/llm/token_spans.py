"""Token counts of sections by the character offsets of whole-document tokens.

A document is encoded once, as a whole; the character spans of its tokens
are joined to the spans of its sections (fields laid end to end, or lines) by
interval. A token that crosses a boundary is counted where its first character
stands; ``n_crossing`` says how many tokens of a section reach beyond its end.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bancalyt.llm import token_store
from bancalyt.llm.common import blocks, workers_find_package

TOKENIZER = "byte_bpe_50k.json"
#: what ends a section of a text: a line end, which belongs to the section
SECTION_END = "\n"


class Offsets:
    """First character and end of every token of a text.

    Byte-level tokens lie side by side in the text's UTF-8 bytes, so that the
    lengths of the tokens give their byte spans; a byte belongs to the
    character that it is part of."""

    def __init__(self, path: str):
        self.encoder = token_store.load(path)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.all_spans([text])[0]

    def all_spans(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        return [self._spans(t, ids) for t, ids in zip(texts, self.encoder.encode_all([t.encode() for t in texts]), strict=True)]

    def _spans(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(self.encoder.sizes[np.frombuffer(ids, "<u4")])
        begins = np.concatenate([[0], ends[:-1]])[:len(ends)]
        if text.isascii():
            return begins, ends
        character = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        return character[begins] - 1, character[ends - 1]


@functools.lru_cache(maxsize=2)
def load(name: str) -> Offsets:
    """The offsets of a file: a path, or a name that public_tokenizers knows."""
    if not os.path.exists(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Offsets(name)


def attribute(first: np.ndarray, last: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and those of them that reach beyond its end, from the
    tokens' spans and the ascending ends of sections that cover the text."""
    section = np.searchsorted(ends, first, "right")
    crossing = section[last > ends[section]] if len(ends) else section
    return np.bincount(section, minlength=len(ends)), np.bincount(crossing, minlength=len(ends))


def _line_ends(text: str) -> np.ndarray:
    """The ends of the lines of a text, each with its line end."""
    sizes = np.fromiter((len(x) + 1 for x in text.split(SECTION_END)), np.int64)
    ends = np.cumsum(sizes)
    ends[-1] -= 1
    return ends if len(ends) < 2 or ends[-1] > ends[-2] else ends[:-1]


def section_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, section (from 0), first_char, n_chars, n_tokens, n_crossing of
    every line of every text.

    A null or empty text has one empty section without tokens. Repeated rows
    give repeated results."""
    workers_find_package(docs.sparkSession)

    def run(batches):
        own = load(tokenizer)
        for batch in blocks(batches, "text"):
            of, columns = [], [[], [], [], [], []]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, (text, spans) in enumerate(zip(texts, own.all_spans(texts), strict=True)):
                ends = _line_ends(text)
                begin = np.concatenate([[0], ends[:-1]])
                tokens, crossing = attribute(*spans, ends)
                of.append(np.full(len(ends), i))
                for column, values in zip(columns, (np.arange(len(ends)), begin, ends - begin, tokens, crossing), strict=True):
                    column.append(values)
            if of:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(np.concatenate(of))), *(pa.array(np.concatenate(c).astype(np.int64)) for c in columns)],
                    ["doc_id", "section", "first_char", "n_chars", "n_tokens", "n_crossing"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, section long, first_char long, n_chars long, n_tokens long, n_crossing long")


def field_counts(rows: DataFrame, fields: list[str], key: str = "doc_id", separator: str = "\n", tokenizer: str = TOKENIZER) -> DataFrame:
    """``key`` with one column of token counts per field (``n_<field>``): the
    fields of a row are laid end to end with ``separator``, which belongs to the
    field before it, and encoded once. Null fields are empty."""
    workers_find_package(rows.sparkSession)
    held = rows.select(rows[key].alias("_key"), *[rows[f].cast("string").alias(f"_f{i}") for i, f in enumerate(fields)])

    def run(batches):
        own = load(tokenizer)
        for batch in batches:
            out = []
            for values in zip(*(batch.column(i + 1).to_pylist() for i in range(len(fields))), strict=True):
                parts = [(v or "") + (separator if i + 1 < len(fields) else "") for i, v in enumerate(values)]
                ends = np.cumsum([len(p) for p in parts])
                first, last = own.spans("".join(parts))
                out.append(attribute(first, last, ends)[0])
            table = np.array(out, np.int64).reshape(-1, len(fields))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(table[:, i]) for i in range(len(fields)))], ["_key", *(f"_n{i}" for i in range(len(fields)))])

    kind = held.schema["_key"].dataType.simpleString()
    out = held.mapInArrow(run, f"_key {kind}, " + ", ".join(f"_n{i} long" for i in range(len(fields))))
    return out.select(out["_key"].alias(key), *[out[f"_n{i}"].alias(f"n_{f}") for i, f in enumerate(fields)])
