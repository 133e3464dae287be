"""Plain versions of the operators, for small inputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_by(rows):
    return sorted(map(tuple, rows), key=repr)


def shared_passages(seed=5, count=120):
    """Rows (doc_id, text): pieces of a few passages among random words, nulls,
    empties, repeats within a text, repeated rows and rows without id."""
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 7))) for _ in range(400)]

    def text(n):
        return pick.choice([" ", "\n", "  "]).join(pick.choice(words) for _ in range(n))

    passages = [text(pick.randint(50, 400)) for _ in range(10)]
    rows = []
    for i in range(count):
        parts = []
        for _ in range(pick.randint(1, 4)):
            if pick.random() < 0.6:
                p = pick.choice(passages)
                begin = pick.randint(0, len(p) // 2)
                parts.append(p[begin:begin + pick.randint(300, 900)])
            else:
                parts.append(text(pick.randint(5, 80)))
        rows.append((i, " ".join(parts)))
    return rows + [(500, None), (501, ""), (None, passages[0]), (None, passages[0]), (7, rows[7][1]), (502, "ab " * 700),
                   (503, "x" * 1300), (504, "\n".join([passages[1]] * 3)), (505, " \n ")]


def _covered(n, window, recurs):
    mask = bytearray(n)
    for i in range(n - window + 1):
        if recurs(i):
            mask[i:i + window] = b"\1" * window
    return mask


def without_strings(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        mask = _covered(len(t), window, lambda i, t=t: seen[t[i:i + window]] > 1)
        kept = bytes(b for b, m in zip(t, mask, strict=True) if not m)
        spans = sum(1 for i in range(len(t)) if mask[i] and (not i or not mask[i - 1]))
        out.append((doc_id, len(t), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return rows_by(out)


def without_phrases(rows, window):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(t[i:i + window]) for t in texts for i in range(len(t) - window + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        mask = _covered(len(t), window, lambda i, t=t: seen[tuple(t[i:i + window])] > 1)
        kept = " ".join(w for w, m in zip(t, mask, strict=True) if not m)
        out.append((doc_id, len(t), sum(mask), hashlib.sha256(kept.encode()).hexdigest()))
    return rows_by(out)


def simhash(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, ids, max_bits):
    """The smallest id of each row's component (None if it has no id)."""
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fingerprints[i] ^ fingerprints[j]).count("1") <= max_bits:
                parent[root(i)] = root(j)
    low = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return [low.get(root(i)) for i in range(len(ids))]


def nearest(rows, k, every):
    """{query id: [(id, score)]} of usable vectors."""
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every == 0:
            score = (vectors * v).sum(axis=1)
            order = np.lexsort((ids, -score))
            out[i] = [(int(ids[j]), score[j]) for j in order[ids[order] != i][:k]]
    return out
