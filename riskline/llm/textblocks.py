"""Whole texts of an Arrow batch as flat NumPy arrays: words, word hashes, n-gram hashes.

The operators that run NumPy inside tasks share this module. A batch is cut
into chunks of about ``CHUNK_BYTES`` (a longer text is a chunk of its own), so
the temporary arrays of a task stay at some tens of MB whatever the batch.

Hashes are 64-bit: a word is the sum of a random 64-bit number per byte times
the powers of an odd base, computed for all words of a chunk from one running
sum, then mixed. With k distinct keys about k*k/2^65 pairs collide (3e-6 for
10 million words), which the callers accept or verify.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

#: White space that ends a word: space and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse modulo 2^64 (doubled until long enough)."""
    for k, base in enumerate((_BASE, _INV)):
        p = _powers[k]
        while len(p) < n:
            step = _U(pow(base, len(p), 1 << 64))
            p = np.concatenate([p, p * step])
        _powers[k] = p
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of one chunk. ``hash[i]`` is word i's hash, ``doc[i]`` its text's row in the chunk,
    ``start``/``end`` its bytes in ``data``; ``first[d]:first[d+1]`` are the words of text d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.data, self.offsets = data, offsets
        n = len(offsets) - 1
        low = LOWER[data] if lower else data
        sep = SPACE[data]
        word = ~sep
        begins, ends = word.copy(), word.copy()
        begins[1:] &= sep[:-1]
        ends[:-1] &= sep[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.count)
        power, inverse = _grow(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[low] * power[: len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))

    def ngrams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of k words inside a text, and their text's row."""
        return ngram_hashes(self.hash, self.doc, k)


def ngram_hashes(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    m = len(h) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = doc[:m] == doc[k - 1 :]
    g = h[:m].copy()
    for j in range(1, k):
        g = g * _U(0xD6E8FEB86659FD93) + h[j : m + j]
    return mix(g[whole]), doc[:m][whole]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is alone in its range."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def word_chunks(column: pa.Array, lower: bool = True, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, its words) for each chunk of a string column."""
    data, offsets = text_buffers(column)
    for a, b in chunks(offsets, limit):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted arrays (one or several key columns)."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
