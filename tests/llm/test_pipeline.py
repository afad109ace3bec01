import collections

import pytest

import corpus_pipeline as P
from quern.llm import bpe, jaccard, language, packing, store
from quern.llm.quality import LIMITS, LINE_LIMIT
from tests.llm.test_jaccard import brute as brute_pairs
from tests.llm.test_passages import WORD
from tests.llm.test_quality import slow
from tests.llm.test_tokens import unpacked

SF = "/root/testdata/sf0.001"


def runs_of(rows, k):
    """Documents that share a run of k words with an earlier one, and with which."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = WORD.findall(t.lower())
        runs = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
        for r in runs:
            if r in seen:
                out.setdefault(i, set()).add(seen[r])
        for r in runs:
            seen.setdefault(r, i)
    return out


def groups(ids, pairs):
    label = {i: i for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {find(i) for i in ids}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in P.STAGES:
        path = store.fresh(spark, f"{store.shared_dir(spark)}/stages")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [(df.columns, {r["doc_id"]: r for r in df.collect()} if "text" in df.columns else df.collect()) for df in out]


def test_all_but_the_last_keep_the_columns(stages):
    assert all(c == stages[0][0] for c, _ in stages[:-1])


def test_language_stage(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = {r["doc_id"]: r["accepted"] for r in language.identify(docs, language.train(docs)).collect()}
    assert set(stages[1][1]) == {i for i, ok in verdict.items() if ok}
    assert len(stages[1][1]) > 0.9 * len(stages[0][1])


def test_quality_stage(stages):
    want = set()
    for i, r in stages[1][1].items():
        total, *dup = slow(r["text"])
        if all(d <= most * total for d, most in zip(dup, [*(LIMITS[n] for n in sorted(LIMITS)), LINE_LIMIT])):
            want.add(i)
    assert set(stages[2][1]) == want


def test_near_copies_stage(stages):
    rows = [(i, r["text"]) for i, r in stages[2][1].items()]
    want = groups([i for i, _ in rows], brute_pairs(rows))
    kept = set(stages[3][1])
    assert want <= kept and len(kept - want) <= 0.02 * len(rows)
    assert all(stages[3][1][i] == stages[2][1][i] for i in kept)


def test_passage_stage(stages):
    before = [(i, r["text"]) for i, r in stages[3][1].items()]
    after = [(i, r["text"]) for i, r in stages[4][1].items()]
    assert not runs_of(after, 50)
    touched = {i for i, r in stages[3][1].items() if i not in stages[4][1] or stages[4][1][i]["text"] != r["text"]}
    assert set(runs_of(before, 50)) <= touched
    for i in touched:  # a cut passage shares a seed with an earlier document
        assert i in runs_of(before, 6)


def test_packing_stage(stages):
    rows = {i: r["text"] for i, r in stages[4][1].items()}
    encode = bpe.queue_encoder()
    import numpy as np

    sizes = {}
    for i, t in rows.items():
        raw = (t or "").encode()
        sizes[i] = encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist()
    for i, parts in unpacked(stages[5][1], packing.CAPACITY).items():
        assert [t for _, p in sorted(parts) for t in p] == sizes.pop(i)
    assert not any(sizes.values())


def test_run_gives_the_last_stage(spark, stages):
    got = P.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5][1]))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "s", 0), (1, "same words", "en", "s", 10), (1, "same words", "en", "s", 10), (2, None, "en", None, None), (3, "same words", None, "s", 10), (4, "word " * 50_000, "en", "s", 250_000)]])
def test_stages_bear_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    for _, stage in P.STAGES:
        for df in (docs, docs.withColumn("__lower", docs.text).withColumn("__text", docs.doc_id).withColumn("__cut", docs.lang).withColumn("id", docs.doc_id)):
            got = stage(spark, df, SF)
            out = got.collect()
            if "text" in got.columns:  # what stays is as it was
                assert got.columns == df.columns
                assert not collections.Counter(map(str, out)) - collections.Counter(map(str, df.collect()))
            else:
                texts = {r["doc_id"] for r in df.collect() if r["text"]}
                assert {i for r in out for i in r["doc_ids"]} == texts


def test_exact_stages_join_all_classes(spark):
    """The exact way of the pipeline's join of seeds cuts every variant but the first of a passage."""
    from tests.llm.test_passages import table, variants

    (stage,) = [f for (_, f), (_, g) in zip(P.EXACT_STAGES, P.STAGES) if f is not g]
    rows = variants()
    cut = {r["doc_id"]: len(r["text"].split()) for r in stage(spark, table(spark, rows), "").collect()}
    assert cut[0] == 160 and all(cut[i] <= 120 for i in range(1, 40))


def test_near_copies_compare_a_family_once(spark, monkeypatch):
    """Stage 3 compares a family of near copies in a few lists, not in each of its buckets, and keeps its least id."""
    base = [f"a{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i], f"z{i}", *base[i + 1 :]])) for i in range(150)]
    seen = []
    made = jaccard._lists
    monkeypatch.setattr(jaccard, "_lists", lambda *a: seen.append(store.table(made(*a), "seen")) or seen[0])
    kept = P.near_copies(spark, spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), "").collect()
    assert [r["doc_id"] for r in kept] == [0]
    assert sum(len(r["ids"]) > 64 for r in seen[0].collect()) == 1
