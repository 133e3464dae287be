"""BPE automaton, token store and token spans against the tokenizers library."""

import functools
import hashlib
import json
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bancalyt.llm import bpe, token_spans, token_store
from bancalyt.llm.common import Table, new_path

public_tokenizers = pytest.importorskip("public_tokenizers")


@functools.lru_cache
def library(name, **changes):
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"].update(changes)
    return Tokenizer.from_str(json.dumps(spec))


ODD = ["", " ", "\n\n", "a", "Hello  wörld's 123 naïve <|endoftext|> foo!! x́ ß İ ΑΣ", "a\x1cb c\x85d　e ​ f", "aaaaaaaaaaaa aaaa",
       "日本語テキスト नमस्ते 👩‍👩‍👧 é ̈x", "<|endoftext|><|startoftext|>x<|endoftext", "ȺȾ ẞ ŉ Ĳ ǆ ²½Ⅷ", "x" * 3000, "\x00\x7f\x9f", "   b  \t c"]


def texts(seed, count):
    pick = random.Random(seed)
    for i in range(count):
        kind = i % 3
        if kind == 0:
            yield "".join(pick.choice("aeinthrsod'!. lg12é\n") for _ in range(pick.randint(1, 40)))
        elif kind == 1:
            yield " ".join(chr(pick.choice([pick.randint(33, 0x2FF), pick.randint(33, 0xD7FF)])) * pick.randint(1, 3) for _ in range(4))
        else:
            yield "".join(pick.choice(["a", " the", "  ", "\n", "'s", "　", "é", " \n ", "９", "\x1c", "!"]) for _ in range(pick.randint(0, 14)))


@pytest.mark.parametrize("seed", [1, 2])
def test_bpe_equals_the_library(seed):
    own, lib = bpe.load(bpe.TOKENIZER), library(bpe.TOKENIZER)
    for text in [*ODD, *texts(seed, 3000)]:
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False), text


def test_words_at_once_and_long_words(monkeypatch):
    """Words by themselves, many at once and in pieces have the same ids, whatever the sizes of the tables."""
    lib, pick = library(bpe.TOKENIZER), random.Random(4)
    words = ["".join(pick.choice("aeinthrsodlg") for _ in range(pick.randint(1, 90))) for _ in range(800)]
    want = [lib.encode(w, add_special_tokens=False).ids for w in words]
    automaton = bpe.load(bpe.TOKENIZER).automaton
    assert automaton.encode_all(words) == want
    monkeypatch.setattr(bpe, "PIECE", 7)
    monkeypatch.setattr(bpe, "AT_ONCE", 50)
    monkeypatch.setattr(bpe, "ARC_TABLE", 64)
    assert automaton.encode_all(words) == want
    with pytest.raises(ValueError):
        automaton.encode_all(["ab", "a日"])


def test_gadgets_keep_merge_order():
    """Every word over two letters, against merging by rank."""
    import itertools

    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "b"), ("aa", "aa"), ("ab", "bb"), ("aab", "ab")]
    names = ["a", "b", *dict.fromkeys(x + y for x, y in merges)]
    automaton = bpe.Automaton({s: i for i, s in enumerate(names)}, merges)

    def by_rank(word):
        parts = list(word)
        while True:
            pairs = [(merges.index(p), i) for i, p in enumerate(itertools.pairwise(parts)) if p in merges]
            if not pairs:
                return parts
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    for n in range(11):
        words = ["".join(word) for word in itertools.product("ab", repeat=n)]
        for word, ids in zip(words, automaton.encode_all(words), strict=True):
            assert [names[i] for i in ids] == by_rank(word) == [names[i] for i in automaton._encode_long(word)]


ROWS = [(5, None), (1, ""), (None, "a b"), (3, "x " * 5000), (2, "hi <|endoftext|> yo"), (9, "　 é\n\n a"), (2, "again"), (2, "again")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("ids", F.lit("x")).withColumn("_text", F.lit(1))


def test_bpe_rows(spark):
    lib = library(bpe.TOKENIZER)

    def want(doc_id, text):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))

    assert sorted(map(tuple, bpe.report(frame(spark)).collect()), key=repr) == sorted((want(*r) for r in ROWS), key=repr)
    assert bpe.report(frame(spark, [])).collect() == []


def test_bpe_round_trip(spark):
    ids = bpe.encode(frame(spark), carry=["doc_id", "text"])
    back = bpe.decode(ids, carry=["text", "ids"])
    lib = library(bpe.TOKENIZER)
    for r in back.collect():
        assert r.ids == lib.encode(r.text or "", add_special_tokens=False).ids and r.decoded == lib.decode(r.ids, skip_special_tokens=False)


def store_rows(rows):
    lib, start, out = library(token_store.TOKENIZER), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


UNIQUE = [r for r in ROWS if r[1] != "again"]


@pytest.mark.parametrize("shard", [4 << 20, 8])
def test_store(spark, monkeypatch, shard):
    monkeypatch.setattr(token_store, "SHARD_BYTES", shard)
    got = sorted((tuple(r) for r in token_store.report(frame(spark, UNIQUE)).collect()), key=lambda r: r[1])
    assert got == store_rows(UNIQUE)


def test_store_of_repeated_ids_is_without_gaps(spark):
    got = sorted((tuple(r) for r in token_store.report(frame(spark)).collect()), key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert sorted((r[0] or -1, *r[2:]) for r in got) == sorted((r[0] or -1, *r[2:]) for r in store_rows(ROWS))


def test_store_of_nothing(spark):
    assert token_store.report(frame(spark, [])).collect() == []


def test_store_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((tuple(r) for r in token_store.report(docs).collect()), key=lambda r: r[1])
    assert got == store_rows([(r.doc_id, r.text) for r in docs.collect()])


def test_short_documents_are_read_alone_and_dictionaries_are_checked(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = new_path(spark, "store")
    token_store.write(docs, path)
    lib = library(token_store.TOKENIZER)
    texts_of = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.ids for r in token_store.read(spark, path, [5, 77, 10**9]).collect()}
    assert got == {i: [*lib.encode(texts_of[i], add_special_tokens=False).ids, 0] for i in (5, 77)}
    name, dictionary = token_store.dictionary_of(spark, path)
    assert len(dictionary) > 1000 and hashlib.sha256(dictionary).hexdigest() == name
    folder = path.removeprefix("file://")
    spark.createDataFrame([(name, bytearray(b"other"))], "dict_sha256 string, dictionary binary").write.mode("overwrite").parquet(os.path.join(folder, "dictionary"))
    with pytest.raises(ValueError):
        token_store.dictionary_of(spark, path)


def test_runs_encoded_together_equal_whole_texts():
    own, lib = token_store.load(token_store.TOKENIZER), library(token_store.TOKENIZER)
    some = [*ODD, *texts(7, 3000)]
    for text, ids in zip(some, own.encode_all([t.encode() for t in some]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_table_keeps_what_is_met_again():
    made = []

    def make(keys):
        made.extend(keys)
        return [k * 2 for k in keys]

    table = Table(3)
    for keys in ({1, 2}, {3}, {1, 4}, {1, 4}, {5, 6, 7, 8}):
        held = table.holding(keys, make)
        assert all(held[k] == 2 * k for k in keys)
    assert sorted(made) == [1, 2, 3, 4, 5, 6, 7, 8]


def sections(text):
    """(first, chars, tokens, crossing) per line, from the library's offsets."""
    spans = library(token_spans.TOKENIZER, trim_offsets=False).encode(text, add_special_tokens=False).offsets
    parts = text.split("\n")
    lines = [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] or len(parts) == 1 else [])
    out, begin = [], 0
    for line in lines:
        end = begin + len(line)
        own = [s for s in spans if begin <= s[0] < end]
        out.append((begin, len(line), len(own), sum(s[1] > end for s in own)))
        begin = end
    return out


def test_sections_equal_the_library_offsets(spark):
    rows = [(i, t) for i, t in enumerate([*ODD, *texts(3, 400)])] + [(None, "a\nb"), (0, None)]
    got = {}
    for r in token_spans.section_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got.setdefault((r.doc_id, r.section), []).append(tuple(r)[2:])
    want = {}
    for doc_id, text in rows:
        for k, line in enumerate(sections(text or "")):
            want.setdefault((doc_id, k), []).append(line)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_sections_add_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lib = library(token_spans.TOKENIZER)
    got = {r.doc_id: (r.n, r.c) for r in token_spans.section_counts(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.sum("n_chars").alias("c")).collect()}
    assert got == {r.doc_id: (len(lib.encode(r.text, add_special_tokens=False).ids), len(r.text)) for r in docs.collect()}


def test_fields(spark):
    rows = spark.createDataFrame([(1, "user", "hi there"), (2, None, None), (None, "a", "")], "doc_id long, role string, text string")
    got = {r.doc_id: (r.n_role, r.n_text) for r in token_spans.field_counts(rows, ["role", "text"]).collect()}
    lib = library(token_spans.TOKENIZER)
    for r in rows.collect():
        assert sum(got[r.doc_id]) == len(lib.encode(f"{r.role or ''}\n{r.text or ''}", add_special_tokens=False).ids)
    assert token_spans.section_counts(rows.where("doc_id > 9")).collect() == []


MARKED = ["word, word. Word! word's word'S x'll,'re a.b.c 1.2 f(x)=y_z~ é, é.a Straße;s  a,　b.", "H̱.H, é,é x̸,̸ ΑΣ.a x.Σ 日本.ab a.日",
          "<|endoftext|>.a<|endoftext|>,", "a.<|startoftext|>b,c <|endoftext|", "don't, can''t o'clock'd 'tis. \n.a \t,b ..c"]


def test_marks_after_letters_are_runs_of_their_own():
    """A word is held and encoded once, whatever marks follow it; the ids stay the library's."""
    for own, lib, ids in [(bpe.Tokenizer(public_tokenizers.path(bpe.TOKENIZER)), library(bpe.TOKENIZER), lambda o, t: o.encode(t)),
                          (token_store.Encoder(public_tokenizers.path(token_store.TOKENIZER)), library(token_store.TOKENIZER),
                           lambda o, t: np.frombuffer(o.encode(t), "<u4").tolist())]:
        ids(own, " word, word. word! word")
        assert {r.strip() for r in own.runs.recent} == {b"word", b",", b".", b"!"}
        for text in [*MARKED, "".join(MARKED), *texts(7, 600)]:
            assert ids(own, text) == lib.encode(text, add_special_tokens=False).ids, text


def test_a_waiting_worker_holds_no_runs():
    """Runs are held as bytes while a task works, and not at all when it has ended."""
    own = bpe.Tokenizer(public_tokenizers.path(bpe.TOKENIZER))
    own.encode_all(["some words, some more", "日本 é"])
    assert own.runs.recent and all(type(x) is bytes for kv in own.runs.recent.items() for x in kv)
    own.forget()
    assert not own.runs.recent and not own.runs.past
