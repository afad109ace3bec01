import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import jaccard

WORD = re.compile(r"[0-9A-Za-z_\u0080-\U0010ffff]+")


def grams(text, n=3):
    w = WORD.findall(text.lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, threshold=0.5):
    sets = {i: grams(t) for i, t in rows if i is not None and t and grams(t)}
    return {(a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}


def expanded(rows):
    """All pairs that the result's rows stand for."""
    members = {}
    for r in rows:
        if r["copies"]:
            members.setdefault(r["doc_a"], []).append(r["doc_b"])
    group = lambda i: [i, *members.get(i, [])]
    out = {}
    for r in rows:
        if r["copies"]:
            for a, b in itertools.combinations(sorted(group(r["doc_a"])), 2):
                out[a, b] = (r["shared"], r["total"])
        else:
            for a, b in itertools.product(group(r["doc_a"]), group(r["doc_b"])):
                out[min(a, b), max(a, b)] = (r["shared"], r["total"])
    return out


def corpus(n=160, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("small,depth", [(1500, 4), (4, 3)])
def test_against_brute_force(spark, small, depth):
    rows = corpus()
    want = brute(rows)
    got = expanded(jaccard.similar_pairs(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), small=small, depth=depth).collect())
    assert all(want[k] == v for k, v in got.items())
    assert len(got) >= 0.95 * len(want) > 25


def test_many_copies_and_near_copies(spark):
    base = [f"a{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(200)] + [(200 + i, " ".join([*base[:-1], f"z{i}"])) for i in range(60)]
    got = expanded(jaccard.similar_pairs(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), small=10).collect())
    assert got == brute(rows)
    kept = jaccard.keep_one_of_each_group(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), small=10)
    assert [r["doc_id"] for r in kept.collect()] == [0]


ODD = [(1, "a b", "p"), (2, "A, b!", "q"), (3, "a", "r"), (4, "", "s"), (5, None, "t"), (None, "a b", "u"), (6, "...", "v"), (1, "a b", "w"), (7, "long word " * 100_000, "x"), (8, "word long " * 100_000, "y")]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id BIGINT, text STRING, grams STRING").withColumnRenamed("grams", "id")
    got = jaccard.similar_pairs(df).collect()
    assert sorted((r["doc_a"], r["doc_b"], r["copies"]) for r in got) == [(1, 2, True), (7, 8, True)]
    kept = jaccard.keep_one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=str) == sorted([r for r in df.collect() if r["doc_id"] not in (2, 8)], key=str)
    assert jaccard.similar_pairs(df.limit(0)).count() == 0
    assert jaccard.keep_one_of_each_group(df.limit(0)).count() == 0


def classes(rows, pairs):
    """What similar_classes gives, from all pairs."""
    same = {}
    for i, t in rows:
        same.setdefault(frozenset(grams(t)), []).append(i)
    rep = {i: min(ids) for ids in same.values() for i in ids}
    size = {i: len(ids) for ids in same.values() for i in ids}
    label, links = {i: i for i in rep}, dict.fromkeys(rep, 0)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
        if rep[a] == a and rep[b] == b:
            links[a] += 1
            links[b] += 1
    return {i: (find(i), rep[i], size[i], links[rep[i]]) for i in rep if size[i] > 1 or links[rep[i]]}


def of(df):
    return {r["doc_id"]: (r["class_id"], r["rep"], r["copies"], r["n_links"]) for r in df.collect()}


@pytest.mark.parametrize("small", [1500, 10])
def test_classes_against_brute_force(spark, small):
    rows = corpus(seed=4) + [(1000 + i, " ".join([f"a{j}" for j in range(60)] + [f"z{i % 40}"])) for i in range(90)]
    got = of(jaccard.similar_classes(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), small=small))
    want = classes(rows, brute(rows))
    assert set(got) <= set(want)
    assert {i: v for i, v in got.items() if i >= 1000} == {i: v for i, v in want.items() if i >= 1000}
    assert sum(got.get(i) == v for i, v in want.items()) >= 0.95 * len(want)


def test_classes_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id BIGINT, text STRING, class_id STRING").withColumn("rep", F.lit(1)).withColumn("s1", F.lit("x"))
    assert of(jaccard.similar_classes(df)) == {1: (1, 1, 2, 0), 2: (1, 1, 2, 0), 7: (7, 7, 2, 0), 8: (7, 7, 2, 0)}
    assert jaccard.similar_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.05, 0.1, 0.5])
def test_the_scheme_reaches_its_recall(threshold):
    """By simulation: pairs at the threshold share each slot with that probability."""
    how = jaccard.scheme(threshold, 0.9)
    assert how.runs * how.branches <= how.slots
    rng = np.random.default_rng(1)
    n, found = 300, 0
    a = rng.integers(0, 1 << 32, (n, how.slots), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < threshold, a, rng.integers(0, 1 << 32, a.shape, dtype=np.uint32))
    for x, y in zip(a, b):
        if (x == y).sum() < how.least:
            continue
        met = False
        for r in range(how.runs):
            ways = [r * how.branches + i for i in range(how.branches)]
            paths = [jaccard.K.mix(np.array([x[s]], np.uint64) * np.uint64(how.slots) + np.uint64(s) + jaccard.K.seed(1000 + r)) for s in ways if x[s] == y[s]]
            for _ in range(jaccard.DEPTH - 1):
                paths = [p for q in paths for p, o in zip(jaccard._children(q, x[None], how.branches), jaccard._children(q, y[None], how.branches)) if p == o]
            met |= bool(paths)
        found += met
    assert found >= 0.9 * n - 3 * (n * 0.09) ** 0.5


@pytest.mark.parametrize("sizes,most", [([1] * 10, 4), ([5, 5, 5], 4), ([100, 1, 1, 1], 10), ([3], 1), ([2, 2], 100)])
def test_blocks_keep_every_pair(sizes, most):
    parts = jaccard.in_blocks(np.array(sizes), most)
    assert {p for part in parts for p in itertools.combinations(sorted(part.tolist()), 2)} == set(itertools.combinations(range(len(sizes)), 2))


def test_large_sets_are_compared_in_parts(spark, monkeypatch):
    rows = corpus(60)
    monkeypatch.setattr(jaccard._likely, "__defaults__", (300,))
    got = of(jaccard.similar_classes(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")))
    want = classes(rows, brute(rows))
    assert sum(got.get(i) == v for i, v in want.items()) >= 0.9 * len(want)


def test_threshold_is_inclusive(spark):
    # three common 3-grams of six in all
    rows = [(1, "a b c d e f1 g1"), (2, "a b c d e")]
    got = jaccard.similar_pairs(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), threshold=0.6).collect()
    assert [(r["shared"], r["total"], r["jaccard"]) for r in got] == [(3, 5, 0.6)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100)]
    got = {r["a"]: r["label"] for r in jaccard.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in (100, 101, 102)} == {100}
    assert jaccard.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_runs_reach_the_recall():
    assert jaccard.runs_needed(0.5, 0.99) > 1
    assert jaccard.runs_needed(0.5, 0.999) >= jaccard.runs_needed(0.5, 0.9)


def test_a_family_is_compared_once(spark):
    """The buckets of a family of near copies are put together: each pair is in one list, or in a few of the blocks of one."""
    base = [f"a{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i], f"z{i}", *base[i + 1 :]])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    how = jaccard.scheme(0.5, 0.99)
    _, reps = jaccard._sketched(docs, "doc_id", "text", 3, how.slots)
    for small, most in ((1500, 1), (40, 4)):
        sizes = [len(r["ids"]) for r in jaccard._lists(reps, how, small, 4).where(F.size("ids") > jaccard.FEW if small > 200 else F.lit(True)).collect()]
        assert sum(n * n for n in sizes) <= most * 200**2
        got = jaccard.similar_classes(docs, small=small).collect()
        assert {(r["class_id"], r["n_links"]) for r in got} == {(0, 199)} and len(got) == 200


def test_families_of_rows_and_their_forest():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40):
        sig = rng.integers(0, 3, (n, 16)).astype(np.uint32)
        near = (sig[:, None] == sig[None]).sum(axis=2) >= 9
        label = np.arange(n)
        for _ in range(n):
            label = np.array([label[near[i]].min() for i in range(n)])
        assert jaccard.alike(sig, 9).tolist() == label.tolist()
        a, b = np.nonzero(np.triu(near, 1))
        tree = jaccard._forest(a, b, n)
        assert tree.sum() == n - len(set(label.tolist()))
        joined = np.arange(n)
        for _ in range(n):
            for x, y in zip(a[tree], b[tree]):
                joined[[x, y]] = min(joined[x], joined[y])
        assert joined.tolist() == label.tolist()
