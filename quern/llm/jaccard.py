"""N-gram Jaccard self-join by chosen paths.

A document's set of word n-grams is embedded into MinHash values (slots). A run splits
all sets on a few sampled slots: sets that share the value of a sampled slot go into the
same bucket, and each bucket samples slots anew, from a hash of its path. A set follows
ceil(1 / threshold) branches at each level, so that a pair at the threshold stays together
on one branch or more on average. Buckets that have become small are compared by brute
force, with exact Jaccard similarities of the n-gram sets. Runs are repeated until a pair
at the threshold has been together in some small bucket with the target probability; slots are
four times as many as all runs sample at their first level, or more.

At 100 TB: what is shuffled for the search is a few narrow keys (16 bytes) for each
distinct set and run; n-gram sets travel only for documents that share a bucket, once per
distinct list of members. Equal sets are collapsed beforehand, so thousands of copies cost
one row each. The many buckets of one large family of near copies are put together, so that its
pairs are compared once and not in each of them. What is large is compared block against
block, which is exact and bounds what one task holds; its cost is the square of its distinct sets.
Pairs are counted where they are found and never leave their task; a spanning forest does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import kernels as K
from quern.llm import store

#: Words in an n-gram; least Jaccard similarity; chance that a pair at the threshold is found.
N, THRESHOLD, RECALL = 3, 0.5, 0.99
#: MinHash values kept of each set at least; sets compared by brute force at once; levels at most.
SLOTS, SMALL, DEPTH = 64, 1500, 4
#: n-grams of all sets compared at once, about; a set may have more.
GRAMS = 1 << 20
#: Sets of a bucket whose signatures are held at once; sets of a list up to which it isn't put together with others.
WHOLE, FEW = 1 << 15, 64
#: Slots compared at once.
_CELLS = 1 << 22


_SET = ["s1", "s2", "size"]


def gram_sets(buf: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each row, and the places where rows begin. A row of fewer words has one gram, of all its words."""
    rows = len(off) - 1
    w = K.words(buf, off)
    at, g = K.ngrams(w.hash, w.row, n)
    row = w.row[at]
    count = np.diff(w.first)
    few = np.flatnonzero((count > 0) & (count < n))
    if len(few):
        row = np.concatenate([row, few])
        g = np.concatenate([g, K.spans_hash(w.hash >> np.uint64(8), w.first[few], w.first[few + 1]) ^ K.mix(count[few].astype(np.uint64))])
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    if len(g):
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])])
        row, g = row[new], g[new]
    return g, np.searchsorted(row, np.arange(rows + 1))


def sketch(g: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row that has grams, by its place: MinHash values (rows, slots) and two sums that tell sets apart."""
    full = np.flatnonzero(np.diff(first) > 0)
    at = first[full]
    sig = np.zeros((len(full), slots), np.uint32)
    for j in range(slots if len(full) else 0):
        h = (g ^ K.seed(j)) * np.uint64(0x9E3779B97F4A7C15)
        sig[:, j] = np.minimum.reduceat(h ^ (h >> np.uint64(29)), at) >> np.uint64(20) & np.uint64(0xFFFFFFFF)
    if not len(full):
        return full, sig, np.zeros((0, 2), np.uint64)
    return full, sig, np.stack([np.add.reduceat(g, at), np.bitwise_xor.reduceat(K.mix(g + np.uint64(77)), at)], 1)


def runs_needed(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is missed with probability 1 - recall at most, at the deepest level."""
    missed = 0.0
    branches = math.ceil(1 / threshold)
    for _ in range(depth):
        missed = (1 - threshold * (1 - missed)) ** branches
    return 1 if missed <= 0 else max(1, math.ceil(math.log(1 - recall) / math.log(missed)))


@dataclass(frozen=True)
class Scheme:
    """Branches of a path, runs, slots, and how many slots two sets must have in common to be compared."""

    branches: int
    runs: int
    slots: int
    least: int


def scheme(threshold: float, recall: float, depth: int = DEPTH) -> Scheme:
    """What finds a pair at the threshold with probability recall or more.

    Pairs of a bucket that have fewer than least slots in common aren't compared; that loses a
    tenth of 1 - recall at most, and the runs make up for it.
    """
    if not 0 < threshold <= 1 or not 0 < recall < 1:
        raise ValueError("threshold lies in (0, 1], recall in (0, 1)")
    branches, slots = math.ceil(1 / threshold), SLOTS
    while True:
        least, lost, chance = 0, 0.0, (1 - threshold) ** slots
        while least < slots and lost + chance <= (1 - recall) / 10:
            lost += chance
            chance *= (slots - least) / (least + 1) * threshold / (1 - threshold) if threshold < 1 else 0
            least += 1
        runs = runs_needed(threshold, recall + lost, depth)
        if 4 * runs * branches <= slots:  # runs that share few slots would fail together
            return Scheme(branches, runs, slots, max(1, least))
        slots *= 2


def _children(path: np.ndarray, sig: np.ndarray, branches: int) -> list[np.ndarray]:
    """Paths one level deeper: each path samples its own slots."""
    out = []
    slots = sig.shape[1]
    start = (K.mix(path ^ K.seed(500)) % np.uint64(slots)).astype(np.int64)
    step = 1 + 2 * (K.mix(path ^ K.seed(501)) % np.uint64(slots // 2)).astype(np.int64)
    row = np.arange(len(path))
    for b in range(branches):
        slot = (start + b * step) % slots
        out.append(K.mix(path + K.mix(sig[row, slot].astype(np.uint64) * np.uint64(slots) + slot.astype(np.uint64) + np.uint64(1))))
    return out


def _signatures(column: pa.Array, slots: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, slots), np.uint32)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), slots)


def _sketches(docs: DataFrame, id_col: str, text_col: str, n: int, slots: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.utf8(batch.column(1))
            for lo, hi in K.blocks(off):
                g, first = gram_sets(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], n)
                full, sig, sums = sketch(g, first, slots)
                sums = sums.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(full)), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(np.diff(first)[full].astype(np.int32)), pa.array([s.tobytes() for s in sig], pa.binary())],
                    ["id", "s1", "s2", "size", "sig"],
                )

    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.lower(text_col).alias("t")).mapInArrow(K.tidy(run), "id long, s1 long, s2 long, size int, sig binary")


def _first_paths(reps: DataFrame, how: Scheme) -> DataFrame:
    """Paths of the first two levels, which every set follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _signatures(batch.column(1), how.slots)
            paths = []
            for r in range(how.runs):
                for b in range(how.branches):
                    slot = r * how.branches + b
                    p = K.mix(sig[:, slot].astype(np.uint64) * np.uint64(how.slots) + np.uint64(slot) + K.seed(1000 + r))
                    paths += _children(p, sig, how.branches)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths).view(np.int64)), pa.array(np.tile(batch.column(0).to_numpy(), len(paths)))], ["path", "id"])

    return reps.select("id", "sig").mapInArrow(K.tidy(run), "path long, id long")


def _deeper(rows: DataFrame, how: Scheme) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = _children(batch.column(0).to_numpy().view(np.uint64), _signatures(batch.column(2), how.slots), how.branches)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths).view(np.int64)), pa.array(np.tile(batch.column(1).to_numpy(), how.branches))], ["path", "id"])

    return rows.select("path", "id", "sig").mapInArrow(K.tidy(run), "path long, id long")


def _counted(paths: DataFrame) -> DataFrame:
    """paths with members, of those that more than one set follows. Counts are summed up before they are shuffled; AQE splits a path of many."""
    counts = paths.groupBy("path").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return paths.join(counts, "path")


def similar_in(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Brute force over sorted sets: first and second place, intersection and union of all pairs of at least the threshold."""
    size = np.array([len(s) for s in sets], np.int64)
    m = len(sets)
    every = np.concatenate(sets)
    value, column = np.unique(every, return_inverse=True)
    count = np.bincount(column, minlength=len(value))
    row = np.repeat(np.arange(m), size)
    order = np.argsort(column, kind="stable")
    row, first = row[order], np.cumsum(count) - count
    both = np.zeros((m, m), np.float32)
    few = (count > 1) & (count <= m // 64)
    for c in np.unique(count[few]):  # what few sets have is counted pair by pair
        at = first[few & (count == c)]
        x, y = np.triu_indices(int(c), 1)
        for lo in range(0, len(at), max(1, (1 << 20) // len(x))):
            some = row[at[lo : lo + max(1, (1 << 20) // len(x)), None] + np.arange(c)]
            pair, times = np.unique(some[:, x] * m + some[:, y], return_counts=True)
            both.reshape(-1)[pair] += times
    shared = (count > 1) & ~few
    keep = np.repeat(shared, count)
    place = np.repeat(np.cumsum(shared) - 1, count)[keep]
    row = row[keep]
    width = max(1, (4 << 20) // max(1, m))  # columns at once: 16 MB of floats at most
    n = int(shared.sum())
    for c in range(0, n, width):
        lo, hi = np.searchsorted(place, [c, c + width])
        x = np.zeros((m, min(width, n - c)), np.float32)
        x[row[lo:hi], place[lo:hi] - c] = 1
        both += x @ x.T
    a, b = np.triu_indices(m, 1)
    inter = both[a, b].astype(np.int64)
    union = size[a] + size[b] - inter
    good = inter >= threshold * union
    return a[good], b[good], inter[good], union[good]


def _lists(reps: DataFrame, how: Scheme, small: int, depth: int) -> DataFrame:
    """Distinct lists of sets that some bucket has together: list_id, ids."""
    at = store.table(_counted(_first_paths(reps, how)), "paths")
    parts = [at.where(F.col("members") <= small)]
    level = 2
    while level < depth:
        over = at.where(F.col("members") > small)
        if over.isEmpty():
            break
        at = store.table(_counted(_deeper(over.join(reps.select("id", "sig"), "id"), how)), "paths")
        parts.append(at.where(F.col("members") <= small))
        level += 1
    most = max(small, WHOLE)
    parts.append(at.where((F.col("members") > small) & (F.col("members") <= most)))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    lists = whole.groupBy("path").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    over = at.where(F.col("members") > most)
    if not over.isEmpty():
        blocks = F.ceil(F.col("members") / max(1, most // 2))
        ranked = over.withColumn("block", F.pmod(F.xxhash64("id", "path"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).where("other != block")
        lists = lists.unionByName(ranked.groupBy("path", F.least("block", "other"), F.greatest("block", "other")).agg(F.sort_array(F.collect_list("id")).alias("ids")).select("path", "ids"))
    lists = lists.select(F.xxhash64("ids").alias("list_id"), "ids").dropDuplicates(["list_id"])
    return _likely(lists, reps, how, small)


def in_blocks(size: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of sets so that each two are together in one part, and a part has most n-grams in all, or two blocks of which one is a single set."""
    block = (np.cumsum(size) - size) // max(1, most // 2)
    cut = np.split(np.arange(len(size)), np.flatnonzero(np.diff(block)) + 1)
    if len(cut) <= 2:
        return [np.arange(len(size))]
    return [np.concatenate([cut[i], cut[j]]) for j in range(len(cut)) for i in range(j)]


def alike(sig: np.ndarray, least: int) -> np.ndarray:
    """Components of rows of which two are joined if they have least slots or more in common: for each row, the first of its component.

    Rows that a component has already aren't compared with each other, so a family of near copies takes few steps.
    """
    label = np.full(len(sig), -1)
    left = np.arange(len(sig))
    while len(left):
        first, left = left[0], left[1:]
        label[first] = first
        front = np.array([first])
        while len(front) and len(left):
            n = max(1, _CELLS // (len(left) * sig.shape[1]))
            some, front = front[:n], front[n:]
            hit = (np.count_nonzero(sig[some][:, None] == sig[left][None], axis=2) >= least).any(axis=0)
            label[left[hit]] = first
            front, left = np.concatenate([front, left[hit]]), left[~hit]
    return label


def _likely(lists: DataFrame, reps: DataFrame, how: Scheme, small: int, most: int = GRAMS) -> DataFrame:
    """Lists of sets worth comparing, cut up where they have more than most n-grams or small sets."""
    return _cut(_together(_connected(lists, reps, how)), small, most)


def _connected(lists: DataFrame, reps: DataFrame, how: Scheme) -> DataFrame:
    """What lists connect after pairs with fewer than how.least slots in common are dropped, with the sizes of the sets."""
    members = lists.select("list_id", F.explode("ids").alias("id")).join(reps.select("id", "size", "sig"), "id").groupBy("list_id").agg(F.collect_list(F.struct("id", "size", "sig")).alias("m")).select("m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(0)
            bounds = m.offsets.to_numpy()
            ids, size = (m.values.field(i).to_numpy() for i in range(2))
            sigs = _signatures(m.values.field(2), how.slots)
            out: list[np.ndarray] = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                root = alike(sigs[lo:hi], how.least)
                order = np.lexsort((ids[lo:hi], root))
                out += [g for g in np.split(lo + order, np.flatnonzero(np.diff(root[order])) + 1) if len(g) > 1]
            first = np.concatenate([[0], np.cumsum([len(g) for g in out])]).astype(np.int64)
            at = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([K.lists(ids[at], first, pa.int64()), K.lists(size[at], first, pa.int32())], ["ids", "sizes"])

    found = members.mapInArrow(K.tidy(run), "ids array<long>, sizes array<int>")
    return found.select(F.xxhash64("ids").alias("list_id"), "ids", "sizes").dropDuplicates(["list_id"])


def _together(lists: DataFrame) -> DataFrame:
    """lists, of which those of more than FEW sets that share sets are one list, where all pairs of that are no more than the pairs of each of them."""
    lists = store.table(lists, "likely")
    n = F.size("ids").cast("long")
    large = lists.where(n > FEW).select("list_id", F.col("ids")[0].alias("a"), n.alias("n"), F.arrays_zip("ids", "sizes").alias("m"))
    if large.isEmpty():
        return lists
    members = large.select("a", F.explode("m").alias("m")).select(F.col("m.ids").alias("id"), F.col("m.sizes").alias("size"), "a")
    labels = components(members.select(F.col("id").alias("a"), F.col("a").alias("b")))
    by = large.join(labels, "a").select("list_id", "label", "n")
    sets = labels.groupBy("label").agg(F.count(F.lit(1)).alias("sets"))
    good = by.groupBy("label").agg(F.sum(F.col("n") * F.col("n")).alias("cost"), F.count(F.lit(1)).alias("lists")).join(sets, "label").where("lists > 1 AND sets * sets <= cost").select("label")
    gone = store.table(by.join(good, "label").select("list_id", "label"), "gone")
    one = members.select("id", "size").distinct().join(labels.join(gone.select("label").distinct(), "label").select(F.col("a").alias("id"), "label"), "id")
    one = one.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("id", "size"))).alias("m")).select(F.xxhash64("m.id").alias("list_id"), F.col("m.id").alias("ids"), F.col("m.size").alias("sizes"))
    return lists.join(gone, "list_id", "left_anti").unionByName(one)


def _cut(lists: DataFrame, small: int, most: int) -> DataFrame:
    def made(parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([K.lists(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int64())], ["ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = (c.values.to_numpy() for c in batch.columns)
            bounds = batch.column(0).offsets.to_numpy()
            out, n = [], 0
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                size = np.maximum(sizes[lo:hi].astype(np.int64), most // max(2, small))
                for part in in_blocks(size, most):
                    out.append(ids[lo:hi][part])
                    n += len(part)
                    if n > 1 << 17:
                        yield made(out)
                        out, n = [], 0
            if out:
                yield made(out)

    found = lists.select("ids", "sizes").mapInArrow(K.tidy(run), "ids array<long>")
    return found.select(F.xxhash64("ids").alias("list_id"), "ids").dropDuplicates(["list_id"])


def _sketched(docs: DataFrame, id_col: str, text_col: str, n: int, slots: int) -> tuple[DataFrame, DataFrame]:
    """Every document that has words, with its set's sums and size; and each distinct set's least id, sums, size, signature and number of documents."""
    rows = _sketches(docs, id_col, text_col, n, slots).groupBy("id").agg(F.min(F.struct("s1", "s2", "size", "sig")).alias("x"))
    rows = store.table(rows.select("id", "x.*"), "sketches")
    best = rows.groupBy("s1", "s2", "size").agg(F.min(F.struct("id", "sig")).alias("x"), F.count(F.lit(1)).alias("copies"))
    return rows.select("id", *_SET), store.table(best.select("x.id", *_SET, "x.sig", "copies"), "reps")


def _compared(docs: DataFrame, lists: DataFrame, id_col: str, text_col: str, n: int, threshold: float, give: str) -> DataFrame:
    """What similar sets there are, by give.

    'pairs': pairs of sets (doc_a < doc_b), with intersection and union; 'forest': only pairs that
    connect what each list connects; 'links': the forest, and rows without doc_b that have in
    shared how many sets doc_a is similar to, in parts to be summed up.
    """
    lists = store.table(lists, "lists")
    wanted = lists.select("list_id", F.explode("ids").alias("id")).groupBy("id").agg(F.sort_array(F.collect_list("list_id")).alias("in_lists"))
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.lower(text_col).alias("t"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.utf8(batch.column(2))
            for lo, hi in K.blocks(off):
                g, first = gram_sets(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], n)
                sums = np.append(np.add.reduceat(g, np.minimum(first[:-1], max(0, len(g) - 1))) if len(g) else np.zeros(hi - lo, np.uint64), np.uint64(0))[:-1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sums.view(np.int64)), K.lists(g.view(np.int64), first, pa.int64())], ["id", "in_lists", "s1", "grams"])

    wanted = store.table(wanted, "wanted")
    likely = store.sieve(wanted.select("id"))
    made = wanted.join(texts.where(likely(F.col("id"))), "id").select("id", "in_lists", "t").mapInArrow(K.tidy(sets), "id long, in_lists array<long>, s1 long, grams array<long>").where(F.size("grams") > 0)
    groups = made.withColumn("list_id", F.explode("in_lists")).groupBy("list_id").agg(F.collect_list(F.struct("id", "in_lists", "s1", "grams")).alias("m"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            m = batch.column(1)
            bounds = m.offsets.to_numpy()
            member = m.values
            doc, lists_, s1, grams = (member.field(i) for i in range(4))
            doc, s1 = doc.to_numpy(), s1.to_numpy()
            lf, gf = lists_.offsets.to_numpy(), grams.offsets.to_numpy()
            lv, gv = lists_.values.to_numpy(), grams.values.to_numpy().view(np.uint64)
            out: list[list[np.ndarray]] = [[], [], [], []]
            counts: list[tuple[np.ndarray, np.ndarray]] = []
            for i, me in enumerate(ids):
                at = np.arange(bounds[i], bounds[i + 1])
                at = at[np.lexsort((s1[at], doc[at]))]
                at = at[np.unique(doc[at], return_index=True)[1]]  # where an id repeats, the row that its sketch is of
                if len(at) < 2:
                    continue
                a, b, inter, union = similar_in([gv[gf[j] : gf[j + 1]] for j in at], threshold)
                tree = _forest(a, b, len(at)) if give != "pairs" else np.zeros(len(a), bool)
                if give != "forest":
                    # A pair is given, or counted, by the least list that both are in.
                    own = ~_before(me, [lv[lf[j] : lf[j + 1]] for j in at])[a, b]
                    if give == "pairs":
                        tree = own
                    else:
                        count = np.bincount(np.concatenate([a[own], b[own]]), minlength=len(at))
                        has = np.flatnonzero(count)
                        counts.append((doc[at[has]], count[has]))
                a, b, inter, union = a[tree], b[tree], inter[tree], union[tree]
                for k, v in enumerate((doc[at[a]], doc[at[b]], inter, union)):
                    out[k].append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in out], ["doc_a", "doc_b", "shared", "total"])
            if counts:
                one, n_ = (np.concatenate(v).astype(np.int64) for v in zip(*counts))
                none = pa.nulls(len(one), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(one), none, pa.array(n_), none], ["doc_a", "doc_b", "shared", "total"])

    return groups.mapInArrow(K.tidy(compare), "doc_a long, doc_b long, shared long, total long")


def _before(me: int, lists: list[np.ndarray]) -> np.ndarray:
    """Which two members have a list less than me in common; lists: those of each member."""
    n = len(lists)
    out = np.zeros((n, n), bool)
    value = np.concatenate(lists)
    row = np.repeat(np.arange(n), [len(v) for v in lists])
    less = value < me
    value, row = value[less], row[less]
    order = np.lexsort((row, value))
    value, row = value[order], row[order]
    for g in np.split(row, np.flatnonzero(np.diff(value)) + 1):
        if len(g) > 1:
            out[g[:, None], g] = True
    return out


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Pairs that make up a spanning forest."""
    take = np.zeros(len(a), bool)
    pair = np.full((n, n), -1, np.int32)
    pair[a, b] = pair[b, a] = np.arange(len(a))
    left = np.unique(np.concatenate([a, b]))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            by = pair[front[:, None], left].max(axis=0)
            hit = by >= 0
            take[by[hit]] = True
            front, left = left[hit], left[~hit]
    return take


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Pairs of documents whose sets of word n-grams have a Jaccard similarity of threshold or more.

    Columns doc_a < doc_b, shared and total (sizes of intersection and union), jaccard, and
    copies (of doc_b: true where both have one and the same set). Documents with equal sets
    are represented by the least id among them: each other one is paired with it, as a copy,
    and only the representatives are paired with other sets. All pairs follow from these rows.
    Near copies of one text give as many rows as they have pairs; similar_classes doesn't.

    Words are those of kernels.py, lower-cased. A document of fewer than n words has one
    n-gram, all its words. Documents with a null id, a null or empty text, or no words are in
    no pair. Rows that repeat an id count as one document: it has the least set of
    its rows; it isn't paired with itself. An empty table gives an
    empty one. Other columns are ignored. Similarities are exact; a pair at the threshold is found
    with probability recall or more, a closer one with a greater one. The number of runs and of MinHash values
    follows from threshold and recall (see scheme), so low thresholds cost more.
    """
    how = scheme(threshold, recall, depth)
    rows, reps = _sketched(docs, id_col, text_col, n, how.slots)
    near = _compared(docs, _lists(reps, how, small, depth), id_col, text_col, n, threshold, "pairs")
    same = rows.join(reps.where("copies > 1").select(F.col("id").alias("rep"), *_SET), _SET).where("id != rep")
    same = same.select(F.col("rep").alias("doc_a"), F.col("id").alias("doc_b"), F.col("size").cast("long").alias("shared"), F.col("size").cast("long").alias("total"), F.lit(True).alias("copies"))
    return near.withColumn("copies", F.lit(False)).unionByName(same).select("doc_a", "doc_b", "shared", "total", (F.col("shared") / F.col("total")).alias("jaccard"), "copies")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """One row for each document that has a copy or a link: doc_id, class_id, rep, copies and n_links.

    Two documents are linked if their sets of word n-grams are similar (see similar_pairs, which
    has the same rules for words, nulls, repeated ids and recall). rep is the least id with the
    same set, copies how many documents have it, n_links how many other sets are similar to it.
    class_id is the least id that is connected with the document by links and copies. Rows grow with the documents,
    however many pairs a class has.
    """
    how = scheme(threshold, recall, depth)
    rows, reps = _sketched(docs, id_col, text_col, n, how.slots)
    found = store.table(_compared(docs, _lists(reps, how, small, depth), id_col, text_col, n, threshold, "links"), "links")
    classes = components(found.where("doc_b IS NOT NULL").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")))
    links = found.where("doc_b IS NULL").groupBy(F.col("doc_a").alias("rep")).agg(F.sum("shared").alias("n_links"))
    sets = reps.select(F.col("id").alias("rep"), *_SET, "copies").join(links, "rep", "left").join(classes.select(F.col("a").alias("rep"), "label"), "rep", "left")
    sets = sets.where("copies > 1 OR n_links > 0").withColumn("class_id", F.coalesce("label", "rep")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    return rows.join(sets, _SET).select(F.col("id").alias("doc_id"), "class_id", "rep", "copies", "n_links")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node and the least node of its component, for nodes that have an edge.

    Every node takes the least label of its neighbours and itself, then the label of its
    label, until nothing changes; each round is written to the shared folder.
    """
    both = store.table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).dropDuplicates(), "edges")
    labels = store.table(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        low = labels.join(near, "a").select("a", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("further"))
        new = store.table(low.join(jump, "label", "left").select("a", "old", F.coalesce(F.least("label", "further"), "label").alias("label")), "labels")
        labels = new.select("a", "label")
        if new.where("label != old").isEmpty():
            return labels


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """The rows of docs without those that are linked, by pairs of similar_pairs, to a lesser id; columns unchanged.

    A group is a connected component of similar pairs and of equal sets; the least id stays.
    Rows with a null id or without words stay. Rows that repeat an id stay or go together.
    """
    how = scheme(threshold, recall, depth)
    rows, reps = _sketched(docs, id_col, text_col, n, how.slots)
    near = _compared(docs, _lists(reps, how, small, depth), id_col, text_col, n, threshold, "forest")
    groups = components(store.table(near.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")), "forest"))
    same = rows.join(reps.where("copies > 1").select(F.col("id").alias("rep"), *_SET), _SET).where("id != rep")
    gone = same.select("id").unionByName(groups.where("a != label").select(F.col("a").alias("id")))
    gone = store.table(gone.distinct(), "gone")
    maybe = F.coalesce(store.sieve(gone)(docs[id_col]), F.lit(False)) & docs[id_col].isNotNull()
    name = store.unused(docs.columns, "__gone")
    return docs.where(~maybe).unionByName(docs.where(maybe).join(gone.select(F.col("id").alias(name)), docs[id_col].cast("long") == F.col(name), "left_anti"))
