"""Packing documents into token sequences of one length, by patterns fitted to the length histogram.

Lengths are rounded up to bins. Every way to fill a sequence exactly with up to PARTS bins is
a pattern; non-negative least squares finds how often to use each so that together they use the
histogram up. Rounded counts are filled with documents, and what is left goes, longest
first, where it fits best. Documents longer than a sequence give whole sequences of their own,
and the rest of them is packed like a short one.

The histogram is counted over all rows and has one row for each bin. Packing itself runs in
shards, by a hash, so that tasks stay of one size at any scale; all shards
use the fitted mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import kernels as K
from quern.llm import store

#: Tokens of a sequence; tokens of a bin; documents in a pattern at most; rows in a shard that packs lengths, tokens in one that packs token lists.
CAPACITY, BIN, PARTS, SHARD_ROWS, SHARD_TOKENS = 2048, 32, 4, 200_000, 2 << 20
#: Tokens of sequences that are put together at once.
_TOKENS = 1 << 17


def patterns(bins: int, parts: int = PARTS) -> np.ndarray:
    """Every multiset of up to parts numbers from 1 to bins whose sum is bins, as counts by number (patterns, bins)."""
    found: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            found.append(head)
            return
        if len(head) == parts:
            return
        room = parts - len(head)
        for b in range(min(left, most), (left + room - 1) // room - 1, -1):
            grow((*head, b), left - b, b)

    grow((), bins, bins)
    out = np.zeros((len(found), bins), np.int64)
    for i, p in enumerate(found):
        for b in p:
            out[i, b - 1] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x = np.zeros(n)
    active = np.zeros(n, bool)
    limit = 1e-10 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds or 10 * a.shape[0] + 50):
        w = a.T @ (b - a @ x)
        w[active] = -np.inf
        j = int(w.argmax())
        if w[j] <= limit:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            step = x[at][bad] / np.maximum(x[at][bad] - z[bad], 1e-300)
            x[at] += step.min() * (z - x[at])
            x[at[bad & (x[at] <= 1e-12)]] = 0
            active[at] = x[at] > 1e-12
            if not active.any():
                break
    return x


def fit_mix(histogram: np.ndarray, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns used and how often, for each document of the histogram (counts by bin)."""
    total = int(histogram.sum())
    every = patterns(len(histogram), parts)
    if not total:
        return every[:0], np.zeros(0)
    x = nnls(every.T.astype(float), histogram / total)
    used = np.flatnonzero(x > 0)
    used = used[np.argsort(-x[used], kind="stable")]
    return every[used], x[used]


def pack_shard(length: np.ndarray, mix: np.ndarray, rate: np.ndarray, capacity: int = CAPACITY, width: int = BIN) -> tuple[np.ndarray, ...]:
    """Pack documents of the given lengths: row, start, length, pack and offset of every segment, by pack and offset."""
    row_parts, start_parts, size_parts, pack_parts = [], [], [], []
    whole, rest = length // capacity, length % capacity
    packs = 0
    if whole.sum():
        row = np.repeat(np.arange(len(length)), whole)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(whole) - whole, whole)) * capacity
        row_parts.append(row)
        start_parts.append(start)
        size_parts.append(np.full(len(row), capacity))
        pack_parts.append(np.arange(len(row)))
        packs = len(row)
    item = np.flatnonzero(rest > 0)
    item = item[np.argsort(-rest[item], kind="stable")]
    bin_ = (rest[item] + width - 1) // width
    bins = capacity // width
    queue = [item[bin_ == b + 1] for b in range(bins)]
    left = np.array([len(q) for q in queue], np.int64)
    taken = np.zeros(bins, np.int64)
    pack_of = np.full(len(length), -1, np.int64)
    for pattern, share in zip(mix, rate):
        need = np.flatnonzero(pattern)
        count = min(int(round(share * len(item))), int((left[need] // pattern[need]).min()))
        if count <= 0:
            continue
        for b in need:
            for _ in range(pattern[b]):
                pack_of[queue[b][taken[b] : taken[b] + count]] = packs + np.arange(count)
                taken[b] += count
        left[need] -= count * pattern[need]
        packs += count
    # Best fit for what is left: packs by the room that they have; bit r of open is set if some pack has room r.
    placed = item[pack_of[item] >= 0]
    room = np.full(packs, capacity, np.int64)
    room[: int(whole.sum())] = 0
    np.subtract.at(room, pack_of[placed], rest[placed])
    stacks: dict[int, list[int]] = {}
    for p in np.flatnonzero(room > 0)[::-1].tolist():
        stacks.setdefault(int(room[p]), []).append(p)
    open_ = sum(1 << r for r in stacks)
    for i in item[pack_of[item] < 0].tolist():
        size = int(rest[i])
        fits = open_ >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            p = stacks[r].pop()
            if not stacks[r]:
                open_ &= ~(1 << r)
        else:
            r, p, packs = capacity, packs, packs + 1
        pack_of[i] = p
        if r > size:
            stacks.setdefault(r - size, []).append(p)
            open_ |= 1 << (r - size)
    row_parts.append(item)
    start_parts.append(whole[item] * capacity)
    size_parts.append(rest[item])
    pack_parts.append(pack_of[item])
    row, start, size, pack = (np.concatenate(p).astype(np.int64) for p in (row_parts, start_parts, size_parts, pack_parts))
    order = np.lexsort((row, -size, pack))
    row, start, size, pack = row[order], start[order], size[order], pack[order]
    before = np.cumsum(size) - size
    first = np.concatenate([[True], pack[1:] != pack[:-1]]) if len(pack) else np.zeros(0, bool)
    offset = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(pack))))
    return row, start, size, pack, offset


def _mix(lengths: DataFrame, capacity: int, width: int, parts: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The fitted mix for lengths (column n), and how many rows and tokens there are."""
    if capacity % width:
        raise ValueError("width must divide capacity")
    counted = lengths.groupBy(F.ceil(F.col("n") % capacity / width).alias("b")).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")).collect()
    histogram = np.zeros(capacity // width, np.int64)
    for r in counted:
        if r["b"] > 0:
            histogram[r["b"] - 1] = r["rows"]
    return *fit_mix(histogram, parts), sum(r["rows"] for r in counted), sum(r["tokens"] for r in counted)


def sequences(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", capacity: int = CAPACITY, width: int = BIN, parts: int = PARTS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The packed sequences themselves: pack_id, id_col's values as doc_ids, starts, lengths and tokens.

    A sequence has the tokens of its segments one after another: lengths[i] tokens of doc_ids[i] from starts[i] on, together
    capacity at most. Every token of every row is in one sequence. Null and empty lists have none, ids may be null or repeat, other columns
    are ignored; an empty table gives an empty one. tokens_col is an array, or binary as of bpe.with_tokens: the same sequences but for
    which documents share one, at less cost, since every token of an array is handled by itself wherever rows pass. Tokens are shuffled once, in shards of about shard_tokens tokens (or
    of one long row), by a hash of the row.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    binary = isinstance(docs.schema[tokens_col].dataType, T.BinaryType)
    item = "int" if binary else docs.schema[tokens_col].dataType.elementType.simpleString()
    n = F.floor(F.octet_length(tokens_col) / 4) if binary else F.size(tokens_col)
    rows = store.table(docs.where(n > 0).select(F.col(id_col).alias("id"), n.cast("long").alias("n"), F.xxhash64(F.col(id_col).cast("string"), F.col(tokens_col)).alias("h"), F.col(tokens_col).alias("tokens")), "tokens")
    mix, rate, _, total = _mix(rows, capacity, width, parts)
    shards = max(1, math.ceil(total / shard_tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts = [], []
        for batch in batches:
            keys.append(batch.select(["shard", "id", "h", "n"]))
            parts.append(np.frombuffer(K.utf8(batch["tokens"])[0], "<i4") if binary else batch["tokens"].flatten().to_numpy())
        shard = pa.Table.from_batches(keys)
        tokens = np.concatenate(parts)
        del keys, parts
        # the tokens stay where they are; only their places are sorted
        order = pc.sort_indices(shard, [("id", "ascending"), ("h", "ascending")])
        n = shard["n"].to_numpy().astype(np.int64)
        place, n = (np.cumsum(n) - n)[order.to_numpy()], n[order.to_numpy()]
        ids = shard["id"].take(order).combine_chunks()
        row, start, size, where, _ = pack_shard(n, mix, rate, capacity, width)
        begin = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        begin = np.append(begin, len(where))
        most = max(1, _TOKENS // capacity)
        for lo in range(0, len(begin) - 1, most):
            some = begin[lo : lo + most + 1]
            own = slice(some[0], some[-1])
            first, many = place[row[own]] + start[own], size[own]
            last = np.cumsum(many)
            flat = tokens[np.repeat(first - last + many, many) + np.arange(last[-1])]
            ends = np.append(0, last)[some - some[0]]
            bounds = pa.array((some - some[0]).astype(np.int32))
            lists = lambda values: pa.ListArray.from_arrays(bounds, values)  # noqa: B023, E731
            pack_id = (shard["shard"][0].as_py() << 32) + where[some[:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(pack_id), lists(ids.take(pa.array(row[own]))), lists(pa.array(start[own])), lists(pa.array(many.astype(np.int32))), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))],
                ["pack_id", "doc_ids", "starts", "lengths", "tokens"],
            )

    tidy = K.tidy(run)

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tidy(batches)

    schema = f"pack_id long, doc_ids array<{kind}>, starts array<long>, lengths array<int>, tokens array<{item}>"
    return rows.withColumn("shard", F.pmod("h", F.lit(shards))).groupBy("shard").applyInArrow(tidied, schema)


def pack(sizes: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", capacity: int = CAPACITY, width: int = BIN, parts: int = PARTS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Segments of documents in sequences: pack_id, slot, id_col, start (in the document), length and offset (in the sequence).

    Every token of every row of sizes is in one segment; a sequence holds capacity tokens at
    most. Only a document longer than that is divided, every capacity tokens. Rows whose length is null,
    0 or less have no segment. Rows that repeat an id are packed each on its own; a null id stays
    null. An empty table gives an empty one. Other columns are ignored. width must divide capacity. Which pack a
    document gets depends on the lengths and a hash of the id alone.
    """
    kind = sizes.schema[id_col].dataType.simpleString()
    rows = store.table(sizes.where(F.col(length_col) > 0).select(F.col(id_col).alias("id"), F.col(length_col).cast("long").alias("n")), "lengths")
    mix, rate, count, _ = _mix(rows, capacity, width, parts)
    shards = max(1, math.ceil(count / shard_rows))

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.take(pc.sort_indices(shard, [("id", "ascending"), ("n", "ascending")]))
        row, start, size, where, offset = pack_shard(shard["n"].to_numpy().astype(np.int64), mix, rate, capacity, width)
        first = np.searchsorted(where, where)
        columns = {"pack_id": (shard["shard"][0].as_py() << 32) + where, "slot": (np.arange(len(where)) - first).astype(np.int32), "id": shard["id"].take(pa.array(row)), "start": start, "length": size.astype(np.int32), "offset": offset.astype(np.int32)}
        return pa.table(columns)

    packed = rows.withColumn("shard", F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(shards))).groupBy("shard").applyInArrow(run, f"pack_id long, slot int, id {kind}, start long, length int, offset int")
    return packed.withColumnRenamed("id", id_col)
