"""Rolling hashes and window anchors over numpy arrays.

A sequence is hashed by prefix sums of ``value[i] * M**i`` modulo 2**64, so
that the hash of any stretch is one difference; M is odd, hence invertible.
"""

from __future__ import annotations

import functools

import numpy as np

_M = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer, so that close inputs give unrelated hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_M, -1, 1 << 64)
    out = []
    for base in (_M, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    up, down = _powers(size)
    return up[:n], down[:n]


class Prefix:
    """Hashes of stretches of one sequence of unsigned 64-bit values."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - begin).astype(np.uint64)
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin] + length * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, n: int) -> np.ndarray:
        """The hash of every stretch of ``n`` values, by its first position."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        k = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:k]) * self.down[:k] + np.uint64(n * 0xD6E8FEB86659FD93 & _MASK))


#: unrelated 64-bit values for the 256 bytes
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_M))

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words in UTF-8 bytes (separators are ASCII)."""
    edge = np.diff(np.concatenate([[True], _SEPARATOR[data], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def mark_cuts(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 are an ASCII mark right after an ASCII letter. There
    the patterns of the tokenizers begin a new word, whatever stands around."""
    out = _MARK[data]
    out[1:] &= _LETTER[data[:-1]]
    out[:1] = False
    return out


def run_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of UTF-8 bytes between white space and
    ``mark_cuts``."""
    space, cut = np.append(_SEPARATOR[data], True), np.append(mark_cuts(data), False)
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1] | cut[1:]
    ends[:-1] &= space[1:] | cut[1:]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one array, a line end after each; begin and end of each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), ends - sizes, ends


def words_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of the words of all texts: begin, end (bytes in the joined array),
    64-bit hash, number of the text; and per text the number of its first word
    (one entry more than texts)."""
    data, begin, _ = join_texts(texts)
    first, last = word_spans(data)
    hashes = np.zeros(len(first), np.uint64)
    # pieces of whole words bound the memory of a very long text
    step = 1 << 18
    for i in range(0, len(first), step):
        a, b = first[i:i + step], last[i:i + step]
        lo, hi = a[0], b[-1]
        hashes[i:i + step] = Prefix(BYTE_VALUES[data[lo:hi]]).hashes(a - lo, b - lo)
    owner = np.searchsorted(begin, first, "right") - 1
    return first, last, hashes, owner, np.searchsorted(owner, np.arange(len(texts) + 1))


def window_anchors(order: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """For windows at ``starts`` (ascending positions in ``order``): the place of
    the smallest of ``order[s : s + width]``, the first one if equal.

    It depends on nothing but the window's own content, so that equal windows
    have their anchors at equal places. Returns per run of neighbouring
    windows with one anchor: anchor, first start, last start."""
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    n = len(order)
    packed = (order >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    low, span = packed, 1
    while span * 2 <= width:
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    best = np.minimum(low[starts], low[starts + (width - span)])
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    stop = np.append(new[1:], len(starts)) - 1
    return at[new], starts[new], starts[stop]
