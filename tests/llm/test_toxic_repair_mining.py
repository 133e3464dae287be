"""Toxicity, conversation repair and hard negatives against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bancalyt.llm import hard_negatives, repair, toxicity

SF = "/root/testdata/sf0.01"

# --- hard negatives ---------------------------------------------------------------------------


def mined(rows, every=100, k=5, low=80, high=100):
    """rows: (vec_id, label, vector); the result by sorting all scores."""
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a, (label, v) in usable.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, (other, w) in usable.items() if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            close = [(i, -s) for s, i, other in scored if other != label and low * -p <= 100 * -s <= high * -p][:k]
            out += [(a, positive, n + 1, i, -p, s) for n, (i, s) in enumerate(close)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, anchor int, score string")


@pytest.mark.parametrize("block", [1 << 14, 23])
def test_hard_negatives_with_ties(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "SCORES", 100)
    pick = random.Random(4)
    rows = [(i, pick.randint(0, 3), [pick.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(3)]) for i in range(260)]
    rows += [rows[5], rows[100], (None, 1, [1.0] * 3), (300, None, [1.0] * 3), (400, 1, None), (500, 1, [1.0, None, 0.0]), (600, 1, [1.0, float("nan"), 0.0]),
             (700, 1, [float("inf"), 0.0, 0.0]), (800, 1, []), (801, 2, []), (802, 1, []), (900, 1, [1.0] * 4), (100, 9, [0.0] * 3), (1000, 2, [0.0] * 3)]
    got = hard_negatives.mine(vectors(spark, rows), lambda c: c % 20 == 0).collect()
    assert sorted(map(tuple, got)) == mined(rows, every=20)
    # an own label and other numbers
    got = hard_negatives.mine(vectors(spark, rows), lambda c: c % 100 == 0, positives=2, negatives=9, low=50, high=90).collect()
    want = mined(rows, every=100, k=9, low=50, high=90)
    best = defaultdict(list)
    for r in mined(rows, every=100, k=2, low=-10**6, high=100):
        if r[1] not in best[r[0]]:
            best[r[0]].append(r[1])
    positives = {a: {p for _, p in sorted({(-r[4], r[1]) for r in want if r[0] == a})[:2]} for a in best}
    assert {(r[0], r[1]) for r in map(tuple, got)} <= {(a, p) for a in positives for p in {x[1] for x in want}}
    assert set(map(tuple, got)) <= set(want)


def test_scores_beyond_doubles():
    a, b = np.array([[2 ** 31, 3]]), np.array([[2 ** 31, 1], [2 ** 33, 0]])
    assert hard_negatives.scores_of(a, b).tolist() == [[2 ** 62 + 3, 2 ** 63 - 1]]


@pytest.mark.parametrize("rows", [[], [(0, 1, None)], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])], [(0, 1, [-1.0]), (1, 1, [1.0]), (2, 2, [1.0])]])
def test_nothing_to_mine(spark, rows):
    assert hard_negatives.mine(vectors(spark, rows), lambda c: c % 100 == 0).collect() == mined(rows)


# --- conversation repair ----------------------------------------------------------------------

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
FOLLOWS = {"0": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of a
    conversation's rows (turn, role, text): the least (cost, edits) per state."""
    rows = sorted(((t is not None, t or 0, r, x) for t, r, x in rows))
    seen, faults = set(), []
    for _, _, role, text in rows:
        marks = VISIBLE.findall(text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[0]]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    def inserted(states):
        todo = list(states.items())
        while todo:
            state, (cost, audit, kept) = todo.pop()
            for to in FOLLOWS[state].replace("s", ""):
                new = (cost + 5, audit + "I", (*kept, NAMES[to] + ":"))
                if to not in states or new < states[to]:
                    states[to] = new
                    todo.append((to, new))
        return states

    states = {"0": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        ahead = {}
        for state, (cost, audit, kept) in inserted(states).items():
            options = [(state, (cost + 2, audit + "D", kept))]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for to in FOLLOWS[state]:
                    if role[:1] == to:
                        options.append((to, (cost + more, audit + "K", (*kept, f"{role}:{text}"))))
                    elif to in NAMES:
                        options.append((to, (cost + more + 1, audit + "R", (*kept, f"{NAMES[to]}:{text}"))))
            for to, new in options:
                ahead[to] = min(ahead.get(to, new), new)
        states = ahead
    states = inserted(states)
    cost, audit, kept = min(states[s] for s in "0a" if s in states)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def plain_report(rows):
    """The query over (conv_id, turn, role, text) before the damage."""
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    held = defaultdict(list, {c: [] for c, *_ in rows})
    for c, t, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        held[c] += [(t, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return sorted(((c, *plain_repair(r)) for c, r in held.items()), key=repr)


def conversations(pick, count, length):
    rows = []
    for c in range(count):
        turn = 0
        for _ in range(length(pick)):
            turn += pick.choice([0, 1, 1, 1, 1, 2])
            role = pick.choice(["user", "assistant"]) if pick.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((c, pick.choice([turn] * 9 + [None]), pick.choice([role] * 12 + ["system", "tool", "", None]),
                         pick.choice(["Yes.", "No!", "why?", " \n", "", None, "cut", "Ends. \t", "é", "Yes. no", f"Text {turn}."])))
    rows += [(None, 1, "user", "Hello."), (None, None, "assistant", "Hi."), (count, 0, "user", "One."), (count, 0, "user", "One."), (count + 1, 3, None, None)]
    return rows


def as_table(spark, rows):
    return spark.createDataFrame([(*r, "k", 7) for r in rows], "conv_id long, turn long, role string, text string, part string, exits int")


def test_repair_of_short_conversations(spark):
    rows = conversations(random.Random(1), 150, lambda p: p.randint(1, 9))
    table = as_table(spark, rows)
    assert sorted(map(tuple, repair.report(repair.damaged(table), table).collect()), key=repr) == plain_report(rows)


def test_repair_of_conversations_over_many_tasks(spark):
    rows = conversations(random.Random(2), 4, lambda p: p.choice([20, 90, 400])) + [(2, 5, "user", "Yes.")] * 70
    table = as_table(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, repair.report(repair.damaged(table), table).collect()), key=repr) == plain_report(rows)
        kept = repair.repaired(repair.damaged(table)).orderBy("conv_id", "part", "chunk", "at").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    texts = defaultdict(list)
    for r in kept:
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    want = {(None if c is None else str(c)): r[-1] for c, *r in plain_report(rows)}
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: want[c] for c in texts}


def test_repair_of_nothing(spark):
    none = as_table(spark, [])
    assert repair.report(none, none).collect() == [] and repair.repaired(none).collect() == []
    one = as_table(spark, [(1, 1, "user", "Hi.")])
    assert [tuple(r) for r in repair.report(none, one).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_auction_prices_are_distances():
    pick = random.Random(3)
    for _ in range(200):
        symbols = "".join(pick.choice("suaSUAx-_") for _ in range(pick.randint(0, 7)))
        exits = tuple(pick.choice([0, 1, 5, 10, repair.FAR]) for _ in range(4))
        arcs, prices = repair.arcs_of(symbols, False), repair.converged(symbols, False, exits)
        far = [repair.FAR] * len(arcs)
        far[4 * len(symbols):] = exits
        for _ in range(len(arcs)):
            for node, out in enumerate(arcs):
                far[node] = min([far[node], *(cost + far[head] for cost, _, head in out)])
        assert [min(p, repair.FAR) for p in prices[:4]] == [min(f, repair.FAR) for f in far[:4]]


# --- toxicity ---------------------------------------------------------------------------------


def plain_ratio(train, texts):
    """Mean log-ratio per byte, by the models' formulas on dictionaries."""
    clean = lambda t: re.sub(rb"[^0-9a-z\x80-\xff]+", b" ", (t or "").lower().encode()).split()
    counts = [[Counter() for _ in range(toxicity.ORDER + 1)] for _ in range(2)]
    lefts = [defaultdict(set) for _ in range(toxicity.SHARED + 1)]
    for text, toxic in train:
        for word in clean(text):
            w = b" " + word + b" "
            for at in range(1, len(w)):
                for k in range(1, min(at + 1, toxicity.ORDER) + 1):
                    gram = w[at - k + 1:at + 1]
                    counts[toxic][k][gram] += 1
                    if k <= toxicity.SHARED:
                        lefts[k][gram].add(w[at - k:at + 1] if at >= k else b"")
    totals = [sum(c[1].values()) for c in counts]
    discount = [round(toxicity.DISCOUNT * totals[0] / totals[1] * 64) / 64, toxicity.DISCOUNT]
    rows = [[defaultdict(Counter) for _ in range(toxicity.ORDER + 1)] for _ in range(2)]
    for c in range(2):
        for k in range(1, toxicity.ORDER + 1):
            for gram, n in counts[c][k].items():
                rows[c][k][gram[:-1]][gram] = n

    def shared(gram):
        p = 1 / 256 if len(gram) == 1 else shared(gram[1:])
        own = {g: len(s) for g, s in lefts[len(gram)].items() if g[:-1] == gram[:-1]}
        return (max(own.get(gram, 0) - 0.75, 0) + sum(min(n, 0.75) for n in own.values()) * p) / sum(own.values()) if own else p

    memo = {}

    def rate(c, gram):
        if (c, gram) not in memo:
            k = len(gram)
            if k <= toxicity.SHARED:
                memo[c, gram] = shared(gram)
            else:
                own, d = rows[c][k][gram[:-1]], discount[c]
                lower = rate(c, gram[1:])
                memo[c, gram] = (max(own[gram] - d, 0) + sum(min(n, d) for n in own.values()) * lower) / sum(own.values()) if own else lower
        return memo[c, gram]

    out = []
    for text in texts:
        total = size = 0
        for word in clean(text):
            w = b" " + word + b" "
            size += len(word) + 1
            for at in range(1, len(w)):
                gram = w[max(0, at - toxicity.ORDER + 1):at + 1]
                total += math.log(rate(1, gram)) - math.log(rate(0, gram))
        out.append(total / size if size else 0.0)
    return out


def corpus(pick, count):
    stems = ["lum", "ter", "vo", "ka", "né", "sol", "rin", "da"]
    word = lambda: "".join(pick.choice(stems) for _ in range(pick.randint(1, 4)))
    bad = lambda: "grob" + pick.choice(stems) + pick.choice(stems)
    rows, labels = [], []
    for i in range(count):
        toxic = int(pick.random() < 0.3)
        words = [word() for _ in range(pick.randint(5, 60))]
        for _ in range(toxic * (1 + len(words) // 15)):
            words.insert(pick.randint(0, len(words)), bad())
        rows.append((i, pick.choice([" ", ", ", "\n"]).join(words)))
        labels.append((i, toxic))
    return rows, labels


@pytest.mark.parametrize("hot", [1 << 20, 150])
def test_toxicity_equals_formulas(spark, monkeypatch, hot):
    monkeypatch.setattr(toxicity, "HOT", hot)
    rows, labels = corpus(random.Random(6), 300)
    rows += [(1000, None), (1001, ""), (None, rows[3][1]), (7, rows[7][1]), (1002, "... --- !"), (1003, "zzz qqq" * 500)]
    labels += [(5, None), (None, 1), (7, 0), (7, 0)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, gram string, toxic int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, marks).collect()
    best = defaultdict(int)
    for i, y in labels:
        if i is not None and y is not None:
            best[i] = max(best[i], y)
    known = {i for i, y in labels if i is not None and y is not None}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    train = [(t, best[i]) for i, t in rows if i in known and fold(i) > 1]
    want = plain_ratio(train, [t for _, t in rows])
    assert sorted((str(r.doc_id), round(r.ratio, 5)) for r in got) == sorted((str(i), round(x, 5)) for (i, _), x in zip(rows, want, strict=True))
    by_id = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is None or fold(r.doc_id) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert by_id[1000].score == by_id[1001].score == by_id[1002].score
    held = [r for r in got if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == best[r.doc_id] for r in held]) > 0.9


def test_toxicity_without_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for marks in ([], [(1, 1), (2, 1)], [(1, None)]):
        found = toxicity.score(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
        assert sorted(r.doc_id for r in found) == [1, 2] and {r.score for r in found} == {0.5}
    assert toxicity.score(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).collect() == []
