"""numpy kernels over the UTF-8 buffers of Arrow string columns.

A word is a run of ASCII letters, digits and underscores and of any characters
beyond ASCII; every other character separates. Callers lower-case beforehand,
in the JVM. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; bounds a worker's memory. A longer document is handled alone.
BLOCK_BYTES = 1 << 18

_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_MASK = (1 << 64) - 1

WORD = np.zeros(256, dtype=bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = True
WORD[128:] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base, and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for i, base in enumerate((_R, _R_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def release() -> None:
    """Give memory that isn't used any more back to the system: workers live on after a task, one beside the other."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and release when it has ended."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of uint64 values over all bits (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seed(i: int) -> np.uint64:
    return np.uint64(mix(np.array([(i + 1) * _R & _MASK], np.uint64))[0])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the n + 1 offsets of its rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"", column.type))
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most limit bytes each, or of one row."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


@dataclass
class Words:
    """The words of some rows: row, first byte, end byte and hash of each, and where each row's words begin."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words(buf: np.ndarray, off: np.ndarray) -> Words:
    """Words of rows; off starts at 0 and ends at len(buf)."""
    n = len(buf)
    if n == 0:
        e = np.zeros(0, np.int64)
        return Words(e, e, e, np.zeros(0, np.uint64), np.zeros(len(off), np.int64))
    inside = WORD[buf]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(row, start, end, spans_hash(buf, start, end), first)


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], from prefix sums of one polynomial."""
    p, inv = powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * p[: len(values)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inv[start])


def ngrams(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every n-gram of words that lies within one row."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = hashes[:m].copy()
    for j in range(1, n):
        g *= np.uint64(_R)
        g += hashes[j : j + m]
    at = np.flatnonzero(row[:m] == row[n - 1 :])
    return at, mix(g[at])


def char_counts(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Characters (code points) of spans."""
    count = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=count[1:])
    return count[end] - count[start]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a value occurred before."""
    again = np.zeros(len(keys), bool)
    if len(keys) < 2:
        return again
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if len(twice) == 0:
        return again
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    hit = np.flatnonzero(twice[at] == keys)
    which = at[hit]
    order = np.argsort(which, kind="stable")
    w = which[order]
    again[hit[order[1:][w[1:] == w[:-1]]]] = True
    return again


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the n + 1 places where rows begin."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32), pa.int32()), pa.array(values, kind))
