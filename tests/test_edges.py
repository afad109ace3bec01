"""Null, repeated and odd rows, which the driver's tables don't have."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import education as E
from quern.functions import heuristics as H
from quern.functions import text as T
from quern.operators import corpus as C
from quern.operators import decontamination as D
from quern.operators import educational as U
from quern.operators import lookup as L
from quern.operators import packing as P
from quern.operators import student as M
from quern.sources import readers as R
from quern.sources import writers as S
from quern.streaming import ingest as I

LONG = " ".join(f"t{i}" for i in range(60))
OTHER = " ".join(f"u{i}" for i in range(70))


@pytest.fixture(scope="module")
def index(spark):
    return D.benchmark_index(spark.createDataFrame([(5, LONG), (4, " "), (3, None)], "i BIGINT, text STRING"), F.col("text"), F.col("i"))


def test_ascii_text_stays_in_the_jvm(spark, monkeypatch):
    def picky(s):
        import unicodedata

        assert not any(t is not None and t.isascii() for t in s)
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    monkeypatch.setattr(T, "_nfkc", picky)
    df = spark.createDataFrame([("plain",), ("ﬁne",), (None,), ("",)], "c STRING")
    assert [r["x"] for r in df.select(T.normalize(F.col("c")).alias("x")).collect()] == ["plain", "fine", "", ""]


def test_status_belongs_to_the_row(spark, index):
    rows = [(None, LONG + " x"), (1, LONG + " y"), (1, OTHER + " " + OTHER), (2, None), (3, "short"), (4, OTHER + OTHER), (4, OTHER + OTHER)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("status", F.lit("old"))
    got = sorted((str(r["doc_id"]), r["text"] or "", r["status"]) for r in D.with_status(df, index, "doc_id", F.col("text")).collect())
    want = sorted((str(i), t or "", s) for (i, t), s in zip(rows, ["contaminated", "contaminated", "clean", "too_short", "too_short", "clean", "clean"]))
    assert got == want
    assert D.with_status(df.limit(0), index, "doc_id", F.col("text")).count() == 0


def test_overlaps_of_repeated_ids(spark, index):
    df = spark.createDataFrame([(1, LONG), (1, LONG), (None, LONG), (2, None)], "doc_id BIGINT, text STRING")
    got = D.overlap_listing(df, index, "doc_id", F.col("text")).collect()
    assert sorted((str(r["doc_id"]), r["n_overlaps"]) for r in got) == [("1", 48), ("None", 48)]
    scan = D.scan_corpus(df, spark.createDataFrame([(7, LONG), (8, "few words"), (9, None)], "q BIGINT, t STRING"), "doc_id", F.col("text"), "q", F.col("t"))
    assert sorted((r["q"], str(r["doc_id"]), r["n_overlaps"]) for r in scan.collect()) == [(7, "1", 48), (7, "None", 48)]


def test_first_of_each(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), ("b", None, "p"), ("b", 5, "q"), ("c", None, "r"), ("c", None, "r"), (None, 3, "s")]
    df = spark.createDataFrame(rows, "k STRING, o INT, v STRING")
    got = {r["k"]: r["v"] for r in C.first_of_each(df, F.col("k"), "o").collect()}
    assert got.pop("a") in ("y", "z") and got == {"b": "q", "c": "r", None: "s"}
    assert C.first_of_each(df, F.col("k"), "o").count() == 4 and C.first_of_each(df.limit(0), F.col("k"), "o").count() == 0


def test_judged_rows(spark, index):
    fit = "This is a fine text about words that follow each other, and it goes on. " * 5
    rows = [(None, fit, "en"), (1, fit, "en"), (1, OTHER * 3, "en"), (2, fit, "en"), (3, None, "en"), (4, fit + "more", None), (5, LONG + " and " + LONG, "en"), (6, "", "en"), (7, "copy " + fit, "en"), (7, "copy " + fit, "en")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING").withColumn("tier", F.lit("x")).withColumn("__c", F.lit("y"))
    got = U.judged(df, index).collect()
    assert sorted((str(r["doc_id"]), r["outcome"]) for r in got) == sorted([("None", "duplicate"), ("1", "kept"), ("1", "kept"), ("2", "duplicate"), ("3", "bad_length"), ("4", "language"), ("5", "contaminated"), ("6", "bad_length"), ("7", "kept"), ("7", "kept")])
    assert all(r["n"] == 0 for r in U.funnel(U.judged(df.limit(0), index)).collect())


def test_measures_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "...", "xx"), (4, "word " * 20, "en"), (5, "x" * 30_000, "en")], "doc_id INT, text STRING, lang STRING").withColumn("grade", F.lit("old"))
    got = {r["doc_id"]: r for r in H.measured(df, F.col("text"), F.col("lang")).collect()}
    assert got[1]["passes"] is True and got[2]["grade"] == -1.0 and got[3]["script_consistency"] == 1.0 and got[4]["repetition_ratio"] == 1 / 16
    edu = {r["doc_id"]: r for r in E.measured(df, F.col("text")).collect()}
    assert edu[1]["learner_level"] == edu[2]["learner_level"] == "6-8" and edu[1]["edu_score"] == 0.0 and edu[5]["toxic_hits"] == 0


@pytest.mark.parametrize("word,want", [("the", 1), ("table", 1), ("apples", 2), ("e", 1), ("eye", 1), ("banane", 2), ("rhythm", 1), ("xyz", 1), ("bcd", 1), ("tablee", 1), ("ee", 1)])
def test_syllables_word_by_word(spark, word, want):
    both = spark.range(1).select(H.syllables(F.array(F.lit(word))).alias("one"), H.syllables(F.array(F.lit("Cat"), F.lit(word), F.lit("dog"))).alias("three")).first()
    assert (both["one"], both["three"]) == (want, want + 2)


def test_features_of_repeated_texts(spark):
    ann = spark.createDataFrame([(1,), (1,), (2,), (None,)], "doc_id BIGINT").withColumn("annotation", F.lit(None).cast(C.ANNOTATION))
    texts = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c")], "doc_id BIGINT, text STRING")
    assert sorted((str(r["doc_id"]), r["text"]) for r in C.feature_rows(ann, texts).collect()) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "")]


def test_nearest_centroid(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [5.0, 5.0])], "i INT, v ARRAY<FLOAT>")
    assert [r["topic"] for r in M.nearest_centroid(df, "v", [[0.0, 0.0], [4.0, 4.0]]).orderBy("i").collect()] == [0, None, 1]
    assert {r["topic"] for r in M.nearest_centroid(df, "v", M.fit_topics(df.limit(0), "v")).collect()} == {None}


def test_scaled_ridge_is_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) * [1, 10, 0.1, 3] + [0, 5, 1, -2]
    y = x @ [1, 0.2, -3, 0.5] + rng.normal(size=200)
    df = spark.createDataFrame([(x[i].tolist(), float(y[i])) for i in range(200)] + [(None, 1.0), ([1.0] * 4, None)], "v ARRAY<DOUBLE>, y DOUBLE")
    student = M.train_student(df, "v", "y", {}, alpha=5.0, scaled=True)
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + 5.0 * np.eye(4), z.T @ (y - y.mean()))
    got = [r["quality"] for r in M.score_documents(df.where("v IS NOT NULL AND y IS NOT NULL"), "v", student).collect()]
    assert np.allclose(got, np.clip(z @ w + y.mean(), 0, 5), atol=1e-6)
    with pytest.raises(ValueError):
        M.train_student(df.limit(5), "v", "y", {})


def test_embedding(spark):
    v = {r["i"]: r["v"] for r in spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "i INT, c STRING").select("i", M.embedding(F.col("c"), 8).alias("v")).collect()}
    assert np.isclose(np.dot(v[1], v[1]), 1) and v[2] == v[3] == [0.0] * 8


def test_a_large_vocabulary_is_joined(spark):
    df = spark.createDataFrame([(1, "b a b"), (1, "a"), (None, "c a"), (2, None), (3, "...")], "i BIGINT, text STRING")
    words = P.word_vocabulary(df, F.col("text"))
    assert {r["word"]: r["id"] for r in words.collect()} == {"a": 0, "b": 1, "c": 2}
    ways = [sorted((str(r["i"]), r["ids"]) for r in P.encode_words(df, "i", F.col("text"), words, sent=n).collect()) for n in (100, 0)]
    assert ways[0] == ways[1] == [("1", [0]), ("1", [1, 0, 1]), ("None", [2, 0])]
    assert P.word_vocabulary(df.limit(0), F.col("text")).count() == 0 == P.encode_words(df.limit(0), "i", F.col("text"), words).count()


def test_a_stopped_run_goes_on(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([("a", 1, v), ("b", 2, v), ("c", 3, v)], "shard STRING, k INT, v STRING")
    S.write_chunks(rows("old").where("shard = 'a'"), f"file://{tmp_path}/x", "shard")
    rows("crashed").where("shard = 'b'").write.partitionBy("shard").mode("append").parquet(f"file://{tmp_path}/x/chunks")  # written, but not in the list
    got = S.write_chunks(rows("new"), f"file://{tmp_path}/x", "shard")
    assert sorted((r["shard"], r["v"]) for r in got.collect()) == [("a", "old"), ("b", "new"), ("c", "new")]
    assert S.write_chunks(rows("newer"), f"file://{tmp_path}/x", "shard").where("v = 'newer'").count() == 0


def test_shards_but_those_done(spark, tmp_path):
    df = spark.createDataFrame([(1, "s1"), (2, "s2"), (3, "s3")], "k INT, shard STRING")
    S.write_shards(df, path := f"file://{tmp_path}/s")
    done = spark.createDataFrame([("s2",), (None,), ("s9",)], "shard STRING")
    assert {r["k"] for r in R.shards(spark, path, ["k"], done).collect()} == {1, 3} and R.shards(spark, path, ["k"]).count() == 3


def test_benchmark_modes(spark):
    a = spark.createDataFrame([(1, "a long enough text", None), (2, " ", "x")], "id INT, t STRING, u STRING")
    assert [r["text"] for r in R.benchmark({"a": a}, "any_text", "n").collect()] == ["a long enough text"]
    assert R.benchmark({"a": a}, "per_lang", "n", ["t"], ["zz"]).count() == 0 == R.benchmark({"a": a}, "flores", "n", langs=[]).count()
    with pytest.raises(ValueError):
        R.benchmark({"a": a}, "other", "n")


def test_mixtures(spark):
    df = spark.createDataFrame([(i, c, lang) for lang, n in (("en", 4), ("fr", 2)) for i in range(n) for c in range(2)], "doc_id BIGINT, chunk INT, lang STRING")
    got = P.mixture(df, "doc_id", "lang", {"fr": 3, "en": 5, "xx": 2}).collect()
    assert sorted((r["part"], r["lang"], r["doc_id"], r["chunk"]) for r in got) == [(0, "fr", 0, 0), (0, "fr", 0, 1), (0, "fr", 1, 0), (1, "en", 0, 0), (1, "en", 0, 1), (1, "en", 1, 0), (1, "en", 1, 1), (1, "en", 2, 0)]


def _grams(texts, n):
    words = [t.split() for t in texts]
    return [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in words]


@pytest.mark.parametrize("n", [5, 13])
def test_rolled_keys_are_the_grams(spark, monkeypatch, n):
    monkeypatch.setattr(L, "_SLICE", 40)
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "b", "c"], size)) for size in (0, 1, 4, 5, 12, 13, 14, 60, 200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING").coalesce(1).select("i", L.keys(T.words(F.col("t")), n).alias("k")).collect()
    of = {}
    for r in rows:
        w = texts[r["i"]].split()
        assert len(r["k"]) == max(0, len(w) - n + 1)
        for i, k in enumerate(r["k"]):
            assert of.setdefault((k["h"], k["g"]), tuple(w[i : i + n])) == tuple(w[i : i + n])
    assert len(of) == len(set().union(*_grams(texts, n)))


def test_a_small_index_is_looked_up_without_a_join(spark, index):
    df = spark.createDataFrame([(1, LONG), (2, OTHER), (2, "x " + LONG), (None, LONG + " y"), (3, None), (4, "few")], "doc_id BIGINT, text STRING")
    ways = [D.with_hits(df, index, "doc_id", F.col("text"), sent=n) for n in (1000, 0)]
    both = [sorted((str(r["doc_id"]), str(r["text"]), r["hit"]) for r in x.collect()) for x in ways]
    assert both[0] == both[1] and [x[2] for x in both[0]] == [True, False, True, False, False, True]
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in ways]
    assert "Join" not in plans[0] and "Join" in plans[1]


def test_no_gram_of_the_corpus_is_shuffled_for_tasks(spark):
    tasks = spark.createDataFrame([(1, "a", LONG), (2, "a", OTHER), (3, "b", "few words")], "i BIGINT, task STRING, text STRING")
    corpus = spark.createDataFrame([("x " + LONG,), (None,), ("few words",)], "text STRING")
    among = D.grams_among(corpus, F.col("text"), D.grams_of(tasks, "i", F.col("text")))
    assert among.count() == 48
    assert [(r["task"], r["doc_ids"]) for r in D.task_overlap(tasks, among, "task", "i", F.col("text")).collect()] == [("a", [1])]
    assert D.grams_among(corpus.where("text NOT LIKE 'x%'"), F.col("text"), D.grams_of(tasks, "i", F.col("text"))).count() == 0


def test_words_are_counted_at_the_pace_of_a_plain_pattern(spark):
    every = spark.createDataFrame([(f"a{chr(i)}b",) for i in range(0x3100) if not 0xD800 <= i <= 0xDFFF], "t STRING")
    assert every.where(T.word_count(F.col("t")) != F.regexp_count("t", F.lit(rf"[^{T.SPACE}]+"))).count() == 0
    assert every.where(F.regexp_count("t", F.lit(rf"[[{T.BLACK}]&&[^.!?]]++")) != F.regexp_count("t", F.lit(rf"[^{T.SPACE}.!?]+"))).count() == 0
    text = spark.range(4).select(F.repeat(F.lit("Some words follow each other here. "), 40_000).alias("t")).coalesce(1).cache()

    def took(c):
        best = 1e9
        for _ in range(4):
            began = time.perf_counter()
            text.agg(F.sum(c)).collect()
            best = min(best, time.perf_counter() - began)
        return best

    assert took(T.word_count(F.col("t"))) < 4 * took(F.regexp_count("t", F.lit(r"\S+")))


def test_a_batch_of_the_stream_is_judged_once(spark, index, tmp_path, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    def counted(s):
        calls.add(len(s))
        return s

    monkeypatch.setattr(T, "_nfkc", counted)
    rows = spark.createDataFrame([(i, f"é{i} " + OTHER + " " + OTHER, "en") for i in range(8)], "doc_id BIGINT, text STRING, lang STRING")
    I.take_batch(rows, 0, index, f"file://{tmp_path}/s", 10_000)
    assert spark.read.parquet(f"file://{tmp_path}/s/clean").count() == 8 and calls.value <= 24


def test_rare_words_are_joined_and_the_vocabulary_never_collected(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    def refuse(self):
        raise AssertionError("rows of a vocabulary go to the driver")

    monkeypatch.setattr(Classic, "toPandas", refuse)
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(40)], size)) for size in (1, 3, 30, 200)]
    rows = [(i % 3, t) for i, t in enumerate(texts)] + [(0, texts[2]), (0, texts[2]), (None, texts[3]), (9, None), (8, "...")]
    df = spark.createDataFrame(rows, "i BIGINT, text STRING")
    words = P.word_vocabulary(df, F.col("text"))
    number = {r["word"]: r["id"] for r in words.collect()}
    want = sorted((str(i), [number[x] for x in t.split()]) for i, t in rows if t and t != "...")
    for sent in (1000, 40, 7, 0):
        assert sorted((str(r["i"]), r["ids"]) for r in P.encode_words(df, "i", F.col("text"), words, sent=sent).collect()) == want
    some = words.where("id % 3 <> 1")
    want = sorted((str(i), k) for i, t in rows if t and (k := [number[x] for x in t.split() if x in number and number[x] % 3 != 1]))
    for sent in (1000, 7):
        assert sorted((str(r["i"]), r["ids"]) for r in P.encode_words(df, "i", F.col("text"), some, sent=sent).collect()) == want
    monkeypatch.setattr(P, "_sorted", lambda known: None)
    assert sorted((str(r["i"]), r["ids"]) for r in P.encode_words(df, "i", F.col("text"), some).collect()) == want


@pytest.mark.parametrize("most", [1, 3, 4, 7, 11, 50])
def test_top_grams_without_a_task_that_reads_all(spark, most):
    rows = [(f"g{i}", 1 + (i * 7) % 4) for i in range(12)]
    df = spark.createDataFrame([(g,) for g, n in rows for _ in range(n)], "gram STRING").repartition(5)
    top = C.top_grams(df.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), most)
    assert [(r["gram"], r["n"]) for r in top.collect()] == sorted(rows, key=lambda r: (-r[1], r[0]))[:most]
    assert "Limit" not in top._jdf.queryExecution().optimizedPlan().toString()


def test_memorization_shuffles_packed_places(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "b", "c"], size)) for size in (0, 4, 5, 9, 30, 30, 60)]
    rows = list(enumerate(texts)) + [(3, texts[5]), (None, texts[6]), (20, None)]
    got = C.memorization(spark.createDataFrame(rows, "i BIGINT, t STRING").repartition(3), "i", F.col("t"), parts=7)
    grams = [(i, tuple(w[k : k + 5])) for i, t in rows for w in [(t or "").split()] for k in range(len(w) - 4)]
    times = {}
    for _, g in grams:
        times[g] = times.get(g, 0) + 1
    own = lambda i, least: sum(j == i and times[g] >= least for j, g in grams)
    per = lambda i: (0, 0) if i is None else (own(i, 0), own(i, 3))
    want = sorted((str(i), *per(i)) for i, _ in rows)
    assert sorted((str(r["i"]), r["grams"], r["repeated"]) for r in got.collect()) == want
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
