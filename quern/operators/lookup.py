"""Sorted tables of hashes in every worker, and n-grams rolled from the hashes of their words.

A table reaches the driver as the bytes that executors packed, 8 to 12 for an entry, never as rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries up to which a table is sent to every worker; a larger one is joined.
SENT = 4_000_000
#: Words that are worked on at once.
_SLICE = 1 << 18
_BITS = 22
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_KINDS = {"bigint": np.int64, "int": np.int32}


def arrays(df: DataFrame) -> list[np.ndarray]:
    """The columns of df (bigint or int, no nulls), row by row in no order."""
    kinds = [_KINDS[t] for _, t in df.dtypes]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy().tobytes()], pa.binary()) for c in b.columns], b.schema.names)

    rows = df.mapInArrow(packed, ", ".join(f"{c} BINARY" for c in df.columns)).collect()
    return [np.frombuffer(b"".join(r[i] for r in rows), kind) for i, kind in enumerate(kinds)]


def rolled(column: pa.ListArray, n: int, check: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of all n-grams of lists of word hashes, some rows at a time: the first row, n-grams of each row, h (64 bits) and g (32; empty unless check)."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    words = column.values.to_numpy(zero_copy_only=False)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE, "right")) - 1)
        w = words[offsets[row] : offsets[end]].view(np.uint64)
        sizes = np.diff(offsets[row : end + 1])
        counts = np.maximum(sizes - n + 1, 0)
        at = np.arange(counts.sum()) + np.repeat(offsets[row:end] - offsets[row] - (np.cumsum(counts) - counts), counts)
        both = []
        for k, m in enumerate(_MULTIPLIERS[: 1 + check]):
            x = w if not k else w ^ (w >> np.uint64(29))
            size = max(0, len(w) - n + 1)
            h = np.zeros(size, np.uint64)
            for j in range(n):
                h *= m
                h += x[j : j + size]
            h = h[at]
            h ^= h >> np.uint64(32)
            h *= m
            h ^= h >> np.uint64(29)
            both.append(h)
        yield row, counts, both[0].view(np.int64), (both[1] >> np.uint64(32)).astype(np.uint32).view(np.int32) if check else np.zeros(0, np.int32)
        row = end


def word_hashes(words: Column) -> Column:
    """Hashes of an array of words; null has none."""
    return F.coalesce(F.transform(words, lambda x: F.xxhash64(x)), F.array().cast("array<bigint>"))


class Grams:
    """The n-grams of an index (columns h and g, as keys gives them) in every worker. Use it where fits is true."""

    def __init__(self, known: DataFrame, sent: int = SENT):
        self.fits = known.count() <= sent
        if not self.fits:
            return
        h, g = arrays(known.select("h", "g"))
        order = np.argsort(h, kind="stable")
        h, g = h[order], g[order]
        self.fits = not (h[1:] == h[:-1]).any()  # else two grams share 64 bits
        near = np.zeros(1 << _BITS, bool)
        near[h.view(np.uint64) >> np.uint64(64 - _BITS)] = True
        self._table = known.sparkSession.sparkContext.broadcast((h, g, near))

    @staticmethod
    def _found(table: tuple[np.ndarray, np.ndarray, np.ndarray], column: pa.ListArray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """The first row, the rows counted from it, h and g of places that have a gram of the table."""
        known, check, near = table
        for row, counts, h, g in rolled(column, n):
            some = np.flatnonzero(near[h.view(np.uint64) >> np.uint64(64 - _BITS)])
            if len(some):
                at = np.minimum(np.searchsorted(known, h[some]), len(known) - 1)
                some = some[(known[at] == h[some]) & (check[at] == g[some])]
            yield row, np.searchsorted(np.cumsum(counts), some, "right"), h[some], g[some]

    def any(self, words: Column, n: int) -> Column:
        """Whether a row's words have a gram of the index."""
        table, found = self._table, Grams._found

        def look(column: pa.Array) -> pa.Array:
            hit = np.zeros(len(column), bool)
            for row, rows, _, _ in found(table.value, column, n):
                hit[row + rows] = True
            return pa.array(hit)

        # Said to be nondeterministic, so that a filter on it stays above it and the text before isn't computed once more below.
        return F.arrow_udf(look, "boolean").asNondeterministic()(word_hashes(words))

    def all(self, words: Column, n: int) -> Column:
        """The keys of a row's grams that the index has, with repeats."""
        table, found = self._table, Grams._found

        def look(column: pa.Array) -> pa.Array:
            parts = list(found(table.value, column, n))
            own = np.concatenate([np.zeros(0, np.int64), *[row + rows for row, rows, _, _ in parts]])
            h, g = (np.concatenate([np.zeros(0, k), *[p[i] for p in parts]]) for i, k in ((2, np.int64), (3, np.int32)))
            bounds = np.searchsorted(own, np.arange(len(column) + 1)).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(h), pa.array(g)], ["h", "g"]))

        return F.arrow_udf(look, KEYS)(word_hashes(words))


KEYS = "array<struct<h:bigint,g:int>>"


def keys(words: Column, n: int) -> Column:
    """All n-grams of an array of words as structs of two hashes, h of 64 bits and g of 32."""

    def look(column: pa.Array) -> pa.Array:
        parts = list(rolled(column, n))
        counts, h, g = (np.concatenate([np.zeros(0, k), *[p[i] for p in parts]]) for i, k in ((1, np.int64), (2, np.int64), (3, np.int32)))
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(h), pa.array(g)], ["h", "g"]))

    return F.arrow_udf(look, KEYS)(word_hashes(words))
