"""Whole texts as flat numpy word tables, for tasks that scan Arrow batches.

A batch of UTF-8 texts is one byte buffer with row offsets.  Words are found,
hashed and combined to n-grams with vector operations over that buffer, so a
task holds one bounded piece of a batch and no per-word Python objects.

Nulls and empty texts have no words.  A text longer than ``PIECE_BYTES`` is a
piece of its own: pieces never cut a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20
#: Pieces of scans that hold some 60 bytes for a byte of text: several word or
#: n-gram tables at a time.
SMALL_PIECE_BYTES = 512 << 10
_U = np.uint64
_BASE = 0x9E3779B97F4A7C55          # odd, so that powers never vanish
_STEP = _U(0xD6E8FEB86659FD93)


def _table(is_separator) -> np.ndarray:
    return np.array([is_separator(i) for i in range(256)], dtype=bool)


#: Words between ASCII white space (\x20, \x09-\x0D).
SPACE = _table(lambda i: i == 0x20 or 0x09 <= i <= 0x0D)
#: Words of digits, ASCII letters and anything beyond ASCII.
NON_ALNUM = _table(lambda i: i < 0x30 or 0x3A <= i <= 0x40 or 0x5B <= i <= 0x60 or 0x7B <= i <= 0x7F)
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.array([i + 32 if 0x41 <= i <= 0x5A else i for i in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def least(values: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, index) of the first least value of every ``span`` values in a row."""
    at, k = np.arange(len(values), dtype=np.int32), 1
    while k < span:
        step = min(k, span - k)
        right = values[step:] < values[:-step]
        at = np.where(right, at[step:], at[:-step])
        values = np.minimum(values[step:], values[:-step])
        k += step
    return values, at


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def pieces(off: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay within ``limit`` (one row at least)."""
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """Words of rows ``lo:hi``: byte range, row and 64-bit hash of each.

    ``first[r] : first[r + 1]`` are the words of row ``r`` (counted from lo).
    """

    __slots__ = ("buf", "start", "end", "row", "hash", "first")

    def __init__(self, raw, off, lo, hi, separators, lower=False):
        a, b = int(off[lo]), int(off[hi])
        self.buf = buf = LOWER[raw[a:b]] if lower else raw[a:b]
        rel = off[lo:hi + 1] - a
        n = len(buf)
        inside = ~separators[buf]
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cut = rel[(rel > 0) & (rel < n)]           # a row's end ends a word
            begins[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, rel)
        self.row = np.repeat(np.arange(hi - lo), np.diff(self.first))
        self.hash = self._hash(inside)

    def _hash(self, inside):
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        return self._of(self.buf[inside], self.end - self.start)

    @staticmethod
    def _of(data, size):
        """Hashes of consecutive words of the given sizes."""
        at = np.concatenate(([0], np.cumsum(size)))
        within = np.arange(at[-1]) - np.repeat(at[:-1], size)
        power = np.full(int(size.max()), _BASE, dtype=np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        value = (data.astype(np.uint64) + _U(1)) * power[within]
        return mix(np.add.reduceat(value, at[:-1]) + size.astype(np.uint64) * _STEP)

    def stems(self, length: int) -> np.ndarray:
        """Hashes of the first ``length`` bytes of each word."""
        if not len(self.start):
            return self.hash
        size = np.minimum(self.end - self.start, length)
        begin = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.start - begin, size)
        return self._of(self.buf[at], size)

    def __len__(self):
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, lo: int, hi: int) -> bytes:
        """Words lo to hi (exclusive) of the piece, joined by one space."""
        buf, s, e = self.buf, self.start, self.end
        return b" ".join(buf[s[i]:e[i]].tobytes() for i in range(lo, hi))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``n`` words of one row."""
        m = len(self) - n + 1
        if m <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        acc = np.zeros(m, dtype=np.uint64)
        for j in range(n):
            acc = acc * _STEP + self.hash[j:j + m]
        at = np.flatnonzero(self.row[:m] == self.row[n - 1:])
        return at, mix(acc[at])


def word_batches(column, separators, lower=False, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, Words]]:
    raw, off = buffer_of(column)
    for lo, hi in pieces(off, limit):
        yield lo, hi, Words(raw, off, lo, hi, separators, lower)


def covered_ranges(ranges: list[tuple[int, int]], n: int) -> np.ndarray:
    """Mask of the n words that lie in one of the (start, length) ranges."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length in ranges:
        edge[start] += 1
        edge[min(start + length, n)] -= 1
    return np.cumsum(edge)[:n] > 0
