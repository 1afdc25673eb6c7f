"""Vectorised views of text columns: bytes, words and their 64-bit hashes, as numpy arrays.

A word is a maximal run of bytes that are digits, ASCII letters or part of a non-ASCII character, so in valid UTF-8
it is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. Words never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(max(n, 1 << 20), base, U64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser with a salt."""
    h = (h + U64(((salt + 1) * _BASE) & 0xFFFFFFFFFFFFFFFF)) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(29))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(32))


def column_bytes(column: pa.Array, kind: pa.DataType = pa.large_string()) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (or of a binary one, by ``kind``), and where each row starts and ends; nulls are empty."""
    column = column.cast(kind).fill_null("" if kind == pa.large_string() else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of ``batch`` in turn, as many as hold about ``most`` bytes of text (one row at least), with their bytes."""
    if not batch.num_rows:
        return
    data, offsets = column_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, batch.num_rows)
        yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``marks`` (one for each byte or word) between successive ``offsets``."""
    total = np.zeros(len(marks) + 1, np.float64 if marks.dtype.kind == "f" else np.int64)
    np.cumsum(marks, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Words:
    """Words of several texts: byte bounds, hashes of the lower-cased bytes, and word bounds of each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray
    lower: np.ndarray
    ranges: RangeHash

    def text(self, k: int) -> str:
        return self.lower[self.start[k] : self.end[k]].tobytes().decode("utf-8", "replace")


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal true runs of ``inside`` that don't cross the rows given by ``offsets``."""
    n = len(inside)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | first[:-1]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    return start, end


class RangeHash:
    """64-bit hashes of ``values[start:end]`` for many ranges at once."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.total = np.zeros(len(values) + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[:-1], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start], salt)


class HashTable:
    """Looks up many 64-bit hashes in a small sorted set."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys.astype(U64))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> U64(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of known keys, and which keys these are."""
        at = np.flatnonzero(self.maybe[(h >> U64(44)).astype(np.int64)])
        if not len(at):
            return at, at
        spot = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        good = self.keys[spot] == h[at]
        return at[good], spot[good]

    def marks(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        out[self.find(h)[0]] = True
        return out


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    lower = _LOWER[data]
    start, end = spans(_WORD[data], offsets)
    ranges = RangeHash(lower)
    return Words(start, end, ranges(start, end), np.searchsorted(start, offsets), lower, ranges)


def shingle_hashes(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words (of all its words, if fewer), and their bounds by text."""
    counts = np.diff(w.bounds)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - w.bounds[:-1], n)
    last = np.minimum(first + size, np.repeat(w.bounds[1:], n))
    if (counts[counts > 0] >= size).all():
        h = w.hash[first]
        for k in range(1, size):
            h = mix(h, 7) + w.hash[first + k]
        return mix(h, 11), bounds
    h = np.zeros(len(first), U64)
    for k in range(size):
        here = first + k < last
        h[here] = (mix(h[here], 7) if k else h[here]) + w.hash[first[here] + k]
    return mix(h, 11), bounds


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in ascending order, and their bounds by text."""
    h, bounds = shingle_hashes(w, size)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[keep], row[keep]
    return h, np.searchsorted(row, np.arange(len(bounds)))
