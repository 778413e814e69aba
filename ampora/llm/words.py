"""Words of whole texts as arrays of 64-bit hashes, without a Python object per word.

A word is a longest run of digits, ASCII letters and non-ASCII characters; A-Z count as a-z.
On the UTF-8 bytes this is one table lookup, as every byte of a non-ASCII character is
at least 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20        # text handled at once; a longer text is a slice by itself
U = np.uint64
_FOLD = np.zeros(256, np.uint8)          # separators become 0
for _lo, _hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_lo:_hi + 1] = np.arange(_lo, _hi + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit integers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_LETTER = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; the tables of one slice are kept."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    made = []
    for b in (_BASE, _BACK):
        x = np.full(n, b, U)
        x[0] = 1
        made.append(np.cumprod(x, dtype=U))
    if n <= 2 * SLICE_BYTES:
        _powers = (made[0], made[1])
    return made[0], made[1]


def slices(texts: pa.Array, at_once: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, document ends) of consecutive rows, about ``at_once`` bytes at a time; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + at_once, "right")) - 1)
        last = min(last, n)
        yield data[ends[first]:ends[last]], ends[first + 1:last + 1] - ends[first]
        first = last


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words before each document and in all)."""
    folded = _FOLD[data]
    n = len(folded)
    if not n:
        return np.empty(0, U), np.zeros(len(ends) + 1, np.int64)
    inside = folded != 0
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    edge[0] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:n]
    at, to = np.flatnonzero(start), np.flatnonzero(stop) + 1
    up, down = _power(n)
    sums = np.zeros(n + 1, U)
    np.cumsum(_LETTER[folded] * up[:n], dtype=U, out=sums[1:])
    return mix((sums[to] - sums[at]) * down[at]), np.concatenate([[0], np.searchsorted(at, ends)])


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every run of ``k`` words; a document of fewer, but not none, has one of all its words."""
    count = np.diff(bounds)
    short = (count > 0) & (count < k)
    rolled = np.zeros(max(len(words) - k + 1, 0), U)
    for j in range(k):
        rolled += mix(words[j:len(rolled) + j] + U(j + 1)) * U(_BASE)
        rolled = mix(rolled)
    doc = np.repeat(np.arange(len(count)), count)
    whole = np.flatnonzero(np.arange(len(words)) + k <= np.repeat(bounds[1:], count))
    docs, hashes = doc[whole], rolled[whole]
    if short.any():
        own = []
        for d in np.flatnonzero(short):
            h = U(int(count[d]))
            for w in words[bounds[d]:bounds[d + 1]]:
                h = mix((np.array([w]) + np.array([h])) * U(_BASE))[0]
            own.append(h)
        docs = np.concatenate([docs, np.flatnonzero(short)])
        hashes = np.concatenate([hashes, np.array(own, U)])
        order = np.argsort(docs, kind="stable")
        docs, hashes = docs[order], hashes[order]
    return docs, hashes
