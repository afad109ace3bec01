import numpy as np

from quern.llm import language

SF = "/root/testdata/sf0.01"


def test_kernel_is_the_set_formula():
    texts = ["the cat sat", "le chat est", "die katze", "the dog"]
    m = language.fit(texts, ["en", "fr", "de", "en"], landmarks=2)
    tables = m.tables()

    def grams(t):
        b = t.encode()
        return {b[i : i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}

    land = [texts[i] for i in (2, 0, 3, 1)]  # by language: de, en, en, fr
    known = set().union(*map(grams, land))
    probe = ["a cat and a dog", "xyz", ""]
    got = m.kernel(m.presence(*language._batch(probe), tables))
    for i, t in enumerate(probe):
        p = grams(t) & known
        want = [len(p & grams(z)) / np.sqrt(max(1, len(p)) * len(grams(z))) for z in land]
        assert np.allclose(got[i], want, atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs.where("doc_id % 2 = 0"))
    got = language.identify(docs.where("doc_id % 2 = 1 AND n_chars >= 200"), model).collect()
    assert np.mean([r["lang"] == r["language"] for r in got]) > 0.97
    assert np.mean([r["accepted"] for r in got]) > 0.97


def test_wrong_labels_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    wrong = docs.where("lang = 'de' AND n_chars >= 200").selectExpr("doc_id", "text", "'fr' AS lang")
    got = language.identify(wrong, model).collect()
    assert got and np.mean([not r["accepted"] for r in got]) > 0.95


def test_labels_of_short_or_long_texts_only(spark):
    rows = [(i, "der hund und die katze " * 20, "de") for i in range(20)] + [(100 + i, f"le chat {i}", "fr") for i in range(20)] + [(200 + i, "el perro y el gato " * 3000, "es") for i in range(3)] + [(300, "", "xx"), (301, None, "xx")]
    model = language.train(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING"))
    assert model.languages == ["de", "es", "fr"]
    probe = spark.createDataFrame([(1, "le chat noir", "fr"), (2, "el gato y el perro", "es"), (3, "der hund und die katze", "fr")], "doc_id BIGINT, text STRING, lang STRING")
    got = {r["doc_id"]: r["language"] for r in language.identify(probe, model).collect()}
    assert got == {1: "fr", 2: "es", 3: "de"}


def slow_scores(model, texts, m):
    """Kernel by sets and ridge by its formula, without Nystrom's shortcuts."""
    grams = lambda t: {t.encode()[i : i + n] for n in (1, 2, 3) for i in range(len(t.encode()) - n + 1)}
    land = [grams(t) for t in m]
    known = set().union(*land)
    k = lambda t: np.array([len(grams(t) & known & z) / np.sqrt(max(1, len(grams(t) & known)) * len(z)) for z in land])
    return np.array([k(t) for t in texts]) @ model.weights


def test_scores_against_brute_force():
    texts = ["the cat sat on it", "le chat est la", "die katze war da", "the dog ran off", "un chien passe", "ein hund kam"]
    labels = ["en", "fr", "de", "en", "fr", "de"]
    model = language.fit(texts, labels, landmarks=2)
    land = [t for lang in model.languages for t, x in zip(texts, labels) if x == lang]
    probe = ["a cat and a dog", "le chien est la", "ein katze"]
    assert np.allclose(model.scores(*language._batch(probe), model.tables())[0], slow_scores(model, probe, land), atol=1e-4)


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    english = docs.where("lang = 'en' AND n_chars > 500").first()["text"]
    rows = [(1, english, "en", "z"), (1, english, "en", "z"), (2, "", "en", "z"), (3, None, "en", "z"), (None, english, None, "z"), (4, english, "xx", "z"), (5, english * 400, "en", "z"), (6, "日本語の文章", "en", "z")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, score STRING")
    got = language.identify(df, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["language"] == by[5]["language"] == by[4]["language"] == "en" and by[1]["accepted"] and by[5]["accepted"] and by[4]["accepted"]
    assert by[2]["language"] is None and not by[2]["accepted"] and not by[3]["accepted"]
    assert by[4]["label_score"] is None and by[None]["label_score"] is None and by[1]["label_score"] is not None
    kept = language.keep_accepted(df, model)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {1, 4, 5, None}
    assert language.identify(df.limit(0), model).count() == 0
    empty = language.train(df.limit(0))
    assert [r["accepted"] for r in language.identify(df.limit(1), empty).collect()] == [False]
