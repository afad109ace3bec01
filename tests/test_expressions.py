"""Cases that the driver's tables don't reach."""

import pytest
from pyspark.sql import functions as F

from quern.functions import education as E
from quern.functions import heuristics as H
from quern.functions import text as T
from quern.operators import corpus as C
from quern.operators import decontamination as D
from quern.operators import ordered as O
from quern.operators import packing as P


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("ＡＢ ﬁ", "AB fi"), ("a  b\x00c", "a b c"), ("a    b\n\n\n\nc ", "a b\n\nc"), ("\u0085x\u0085", "x"), (None, ""), ("", ""), ("\tkept\tinside\t", "kept\tinside")])
def test_normalize(spark, raw, want):
    assert one(spark, raw, T.normalize) == want
    assert one(spark, want, T.normalize) == want


@pytest.mark.parametrize("text,want", [("हिन्दी", ["ह", "न", "द"]), ("a_b x²", ["a_b", "x²"]), ("Don't STOP", ["don", "t", "stop"]), ("", [])])
def test_words(spark, text, want):
    got = one(spark, text, T.words)
    assert got == want or text == "हिन्दी" and len(got) == 3


@pytest.mark.parametrize("n,grams", [(12, 0), (13, 1), (14, 2), (0, 0)])
def test_grams_at_the_bound(spark, n, grams):
    assert len(one(spark, " ".join(f"w{i}" for i in range(n)), lambda c: T.ngrams(T.words(c), 13))) == grams


@pytest.mark.parametrize("n,status", [(199, "too_short"), (200, "ok"), (100_000, "ok"), (100_001, "too_long")])
def test_length_bounds(spark, n, status):
    assert one(spark, "é" * n, T.length_status) == status


@pytest.mark.parametrize("raw,want", [("call 123-45-6789", "call [PHONE]"), ("see http://a@b.co/x", "see http://[EMAIL]/x"), ("12-3", "12-3")])
def test_masks(spark, raw, want):
    assert one(spark, raw, T.mask_personal) == want


def test_fenced_json(spark):
    for reply in ('```json\n{"a":1}\n```', '{"a":1}', 'x ```\n{"a":1}``` y', '```json{"a":1}'):
        assert one(spark, reply, T.fenced_json) == '{"a":1}'


def test_readability_edges(spark):
    assert one(spark, "one two three four five six seven eight nine", H.flesch_kincaid) == -1.0
    assert one(spark, "a " * 10, H.flesch_kincaid) == pytest.approx(0.39 * 10 + 11.8 - 15.59)
    assert one(spark, "", H.sentence_length) == 0.0
    assert one(spark, "的" * 600 + "。", lambda c: H.script_consistency(c, F.lit("zh"))) == 1.0
    assert one(spark, "...", lambda c: H.script_consistency(c, F.lit("en"))) == 0.0
    assert one(spark, "...", lambda c: H.script_consistency(c, F.lit("tlh"))) == 1.0
    assert one(spark, "word", lambda c: H.stopword_density(T.words(c), F.lit("zh"))) == 0.0


def test_toxicity_needs_three_kinds(spark):
    assert one(spark, "damn kys", E.toxicity) == pytest.approx(2 / 3)
    assert one(spark, "damn kys isis", E.toxicity) == 1.0


def test_empty_text_has_the_middle_level(spark):
    assert one(spark, "", E.learner_level) == "6-8" and one(spark, "", E.educational_score) == 0.0


@pytest.mark.parametrize("parts", [1, 5])
def test_prefix_sums_do_not_depend_on_partitions(spark, parts):
    rows = [(i, i % 3, (i * 7) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "k BIGINT, g INT, v INT").repartition(parts)
    got = {r["k"]: r["b"] for r in O.prefix_sum(df, "k", F.col("v"), "b", group="g").collect()}
    run = {}
    for k, g, v in rows:
        assert got[k] == run.get(g, 0)
        run[g] = run.get(g, 0) + v
    assert O.dense_ids(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("target", [9, 10, 11])
def test_budget_around_a_prefix(spark, target):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "k BIGINT, w INT")
    assert O.word_budget(df, "k", F.col("w"), target).count() == (2 if target <= 10 else 3)


def test_largest_remainder_is_exact(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "name STRING, n BIGINT")
    got = {r["name"]: r["share"] for r in O.largest_remainder(df, "name", "n", "name", 10).collect()}
    assert got == {"a": 4, "b": 3, "c": 3}


@pytest.mark.parametrize("n", [0, 512, 513, 514, 1026])
def test_chunks_lose_only_the_rest(spark, n):
    df = spark.range(1).select(F.lit(1).alias("d"), (F.array_repeat(F.lit(7), n)).alias("ids"))
    got = P.chunks(df, "ids", 513, ["d"])
    assert got.count() == n // 513 and all(len(r["input_ids"]) == 513 for r in got.collect())
    stats = P.chunk_stats(df, "ids", 513).first()
    assert stats["chunks"] * 513 + stats["discarded"] == stats["tokens"] == n


def test_short_documents_fill_blocks(spark):
    df = spark.createDataFrame([(i, [i] * 3) for i in range(7)], "d BIGINT, ids ARRAY<INT>")
    got = [r["input_ids"] for r in P.across_documents(df, "d", "ids", 5).orderBy("block").collect()]
    flat = [i for i in range(7) for _ in range(3)]
    assert got == [flat[a : a + 5] for a in range(0, 20, 5)]


def test_last_annotation_and_held_out(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k STRING, o INT, v STRING")
    assert {r["k"]: r["v"] for r in C.last_annotation(df, "k", "o").collect()} == {"a": "y", "b": "z"}
    full = spark.createDataFrame([("p",), ("q",), ("q",), (" ",), (None,)], "t STRING")
    assert [r["t"] for r in C.held_out(full, full.where("t = 'p'"), "t").collect()] == ["q", "q"]


def test_clean_documents_do_not_meet_the_index(spark):
    text = " ".join(f"t{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text + " more"), (2, " ".join(f"u{i}" for i in range(70)))], "doc_id BIGINT, text STRING")
    index = D.benchmark_index(spark.createDataFrame([(5, text), (4, " ")], "i BIGINT, text STRING"), F.col("text"), F.col("i"))
    got = {r["doc_id"]: r["status"] for r in D.with_status(docs, index, "doc_id", F.col("text")).collect()}
    assert got == {1: "contaminated", 2: "clean"}
    assert D.contaminated_ids(docs, index.limit(0), "doc_id", F.col("text")).count() == 0
