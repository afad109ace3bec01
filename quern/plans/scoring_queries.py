"""Queries of heuristics, educational rules, annotations, features, models and topics."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from quern.functions import education as E
from quern.functions import heuristics as H
from quern.functions import text as T
from quern.operators import corpus as C
from quern.operators import educational as U
from quern.operators import student as M
from quern.plans.queries import _CW, _GRAMS, _MASK, _W, _WC, _WORDS, _grams, docs, index, text
from quern.plans.registry import register, table
from quern.sources import writers as S


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_STOP = "CASE lang " + " ".join(f"WHEN '{lang}' THEN len(list_filter(w, lambda x: list_contains({_list(H.STOPWORDS[lang])}, x)))" for lang in ("en", "fr", "de", "es")) + " END"
_SENT = r"len(list_filter(string_split_regex(text, '[.!?。！？]+'), lambda x: regexp_matches(x, '\S')))"
_SENT1 = r"len(list_filter(string_split_regex(text, '[.!?]'), lambda x: regexp_matches(x, '\S')))"
_SYL = "coalesce(list_sum(list_transform(cw, lambda x: greatest(1, len(regexp_extract_all(lower(x), '[aeiouy]+'))) - CASE WHEN ends_with(lower(x), 'e') AND len(regexp_extract_all(lower(x), '[aeiouy]+')) > 1 THEN 1 ELSE 0 END)), 0)"
_CHARS = "coalesce(list_sum(list_transform(cw, lambda x: length(x))), 0)"
_BASE = f"b0 AS (SELECT *, {_W} AS w, {_CW} AS cw, {_SENT} AS sents, {_SENT1} AS sents1 FROM documents), b1 AS (SELECT *, {_SYL} AS syl, {_CHARS} AS chars FROM b0)"
_NEUTRAL = H._NEUTRAL.replace("'", "''")
_HEU = f"""WITH {_BASE}, b2 AS (SELECT *, left(regexp_replace(text, '{_NEUTRAL}', '', 'g'), 500) AS sample, {_grams(5)} AS g5 FROM b1),
h AS (SELECT doc_id, lang,
CASE WHEN len(w) > 0 THEN coalesce(({_STOP}) / len(w), 0.0) ELSE 0.0 END::DOUBLE AS stopword_density,
CASE WHEN len(cw) < 10 THEN -1.0 ELSE 0.39 * (len(cw) / greatest(1, sents)) + 11.8 * (syl / len(cw)) - 15.59 END::DOUBLE AS grade,
CASE WHEN len(cw) < 5 THEN 0.0 ELSE len(cw) / greatest(1, sents) END::DOUBLE AS sentence_length,
CASE WHEN len(cw) < 5 THEN 0.0 ELSE chars / len(cw) END::DOUBLE AS letters_in_word,
CASE WHEN length(sample) = 0 THEN 0.0 ELSE length(regexp_replace(sample, '[^\\p{{Latin}}]', '', 'g')) / length(sample) END::DOUBLE AS script_consistency,
CASE WHEN len(w) < 10 THEN 1.0 ELSE len(list_distinct(g5)) / len(g5) END::DOUBLE AS repetition_ratio FROM b2),
hp AS (SELECT *, stopword_density BETWEEN 0.03 AND 0.60 AND CASE WHEN lang = 'en' THEN grade < 0 OR grade BETWEEN 1 AND 18 ELSE sentence_length <= 0 OR (sentence_length BETWEEN 3 AND 80 AND letters_in_word BETWEEN 2 AND 20) END AND script_consistency >= 0.6 AND repetition_ratio >= 0.3 AS passes FROM h)"""


@register("heu1_stopword_density", f"{_HEU} SELECT doc_id, stopword_density FROM h")
def heu1(s, d):
    return docs(s, d).select("doc_id", H.stopword_density(T.words(text()), F.col("lang")).alias("stopword_density"))


@register("heu2_flesch_kincaid", f"{_HEU} SELECT doc_id, grade FROM h")
def heu2(s, d):
    return docs(s, d).select("doc_id", H.flesch_kincaid(text()).alias("grade"))


@register("heu3_sentence_and_word_length", f"{_HEU} SELECT doc_id, sentence_length, letters_in_word FROM h")
def heu3(s, d):
    return docs(s, d).select("doc_id", H.sentence_length(text()).alias("sentence_length"), H.letters_in_word(text()).alias("letters_in_word"))


@register("heu4_script_consistency", f"{_HEU} SELECT doc_id, script_consistency FROM h")
def heu4(s, d):
    return docs(s, d).select("doc_id", H.script_consistency(text(), F.col("lang")).alias("script_consistency"))


@register("heu5_repetition_ratio", f"{_HEU} SELECT doc_id, repetition_ratio FROM h")
def heu5(s, d):
    return docs(s, d).select("doc_id", H.repetition_ratio(T.words(text())).alias("repetition_ratio"))


def _measured(s, d):
    return H.measured(docs(s, d).select("doc_id", "lang", "text"), text(), F.col("lang"))


@register("heu6_gate", f"{_HEU} SELECT doc_id, passes FROM hp")
def heu6(s, d):
    return _measured(s, d).select("doc_id", "passes")


@register("heu7_stats", f"{_HEU} SELECT doc_id, stopword_density, grade, sentence_length, letters_in_word, script_consistency, repetition_ratio, passes FROM hp")
def heu7(s, d):
    return _measured(s, d).select("doc_id", *H.MEASURES)


@register("heu8_reject_rate", f"{_HEU} SELECT lang, count(*) AS docs, sum(passes::INT)::BIGINT AS kept, 1 - sum(passes::INT) / count(*) AS reject_rate FROM hp GROUP BY lang")
def heu8(s, d):
    rows = _measured(s, d).groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("passes").cast("long")).alias("kept"))
    return rows.withColumn("reject_rate", 1 - F.col("kept") / F.col("docs"))


# Educational rules


# Word boundaries of SQL know ASCII only, so plain has other letters as one of them.
def _matches(pattern: str) -> str:
    return "regexp_matches(plain, '" + pattern.replace("'", "''") + "')"


def _count(pattern: str) -> str:
    return "len(regexp_extract_all(plain, '" + pattern.replace("'", "''") + "'))"


_HITS = " + ".join(f"{_matches(p)}::INT" for p in E.TOXIC)
_PARTS = r"list_filter(string_split_regex(text, '[.!?]'), lambda x: regexp_matches(x, '\S'))"
_EDU = rf"""e0 AS (SELECT *, regexp_replace(regexp_replace(text, '[^\x00-\x7F\p{{L}}\p{{N}}]', ' ', 'g'), '[^\x00-\x7F]', 'q', 'g') AS plain, {_WC} AS words, {_W} AS w, {_CW} AS cw, {_PARTS} AS parts, {_SENT1} AS sents1, {_HITS} AS hits FROM src),
e1 AS (SELECT *, CASE WHEN len(parts) > 0 THEN list_sum(list_transform(parts, lambda x: len(regexp_extract_all(x, '\S+')))) / len(parts) END AS mean, {_SYL} AS syl, {_CHARS} AS chars FROM e0),
e2 AS (SELECT *, least({_count(E.POSITIVE)} / greatest(words / 50, 1.0), 2.5) - least({_count(E.NEGATIVE)} / greatest(words / 50, 1.0), 2.0) + CASE WHEN mean BETWEEN 10 AND 25 THEN 1.0 WHEN mean < 5 OR mean > 50 THEN -0.5 ELSE 0.0 END::DOUBLE + CASE WHEN regexp_matches(text, '\n#+\s') THEN 0.5 ELSE 0.0 END::DOUBLE + CASE WHEN regexp_matches(text, '\d+\.') THEN 0.3 ELSE 0.0 END::DOUBLE + CASE WHEN regexp_matches(text, '(?i)\bfigure\b|\btable\b') THEN 0.3 ELSE 0.0 END::DOUBLE AS raw,
len(cw) > 0 AND sents1 > 0 AS usable FROM e1),
e3 AS (SELECT *, CASE WHEN words = 0 THEN 0.0 ELSE least(greatest(raw, 0.0), 5.0) END::DOUBLE AS score, CASE WHEN usable THEN 0.39 * (len(cw) / sents1) + 11.8 * (syl / len(cw)) - 15.59 ELSE 8.0 END::DOUBLE AS fk, CASE WHEN usable THEN chars / len(cw) ELSE 5.0 END::DOUBLE AS mean_length FROM e2),
e4 AS (SELECT *, CASE WHEN fk <= 1 OR mean_length <= 3.5 THEN 'K1' WHEN fk <= 3 THEN '2-3' WHEN fk <= 5 THEN '4-5' WHEN fk <= 8 THEN '6-8' WHEN fk <= 12 THEN '9-12' ELSE 'Adult' END AS level FROM e3),
e5 AS (SELECT *, CASE WHEN level IN ('K1', '2-3', '4-5') THEN 'kids' WHEN level IN ('6-8', '9-12') THEN 'teens' ELSE 'adults' END AS audience, CASE WHEN level IN ('K1', '2-3', '4-5') AND hits = 0 THEN 'kids' WHEN score >= 4 THEN 'edu_high' WHEN score >= 3 THEN 'edu_mid' ELSE 'general' END AS tier FROM e4)"""
_PLAIN = f"WITH src AS (SELECT doc_id, lang, text FROM documents), {_EDU}"


@register("edu1_toxicity", f"{_PLAIN} SELECT doc_id, hits, least(hits / 3, 1.0)::DOUBLE AS toxicity, hits < 3 AS passes FROM e0")
def edu1(s, d):
    return docs(s, d).select("doc_id", E.toxic_hits(text()).alias("hits"), E.toxicity(text()).alias("toxicity"), (E.toxicity(text()) < 0.7).alias("passes"))


def _votes_sql(w: str) -> str:
    """SQL of the detector: the languages' hits, best first, as [{n, at, lang}]."""
    langs = ("en", "fr", "de", "es")
    hits = ", ".join(f"{{'n': -len(list_filter({w}, lambda x: list_contains({_list(H.STOPWORDS[x])}, x))), 'at': {i}, 'lang': '{x}'}}" for i, x in enumerate(langs))
    return f"list_sort([{hits}])"


_ENSEMBLE = "CASE WHEN s[1].lang <> lang THEN 0.0 ELSE (CASE WHEN share < 0.5 OR squash < 0.5 THEN 0.7 ELSE 1.0 END) * ((share + squash) / 2) END::DOUBLE"
_DETECT = "share AS (SELECT *, CASE WHEN total > 0 THEN -s[1].n / total ELSE 0.0 END::DOUBLE AS share, round(1 / (1 + exp(-(s[2].n - s[1].n)::DOUBLE)), 9) AS squash FROM (SELECT *, -list_sum(list_transform(s, lambda x: x.n)) AS total FROM v))"


@register("edu2_language_score", f"WITH v AS (SELECT doc_id, lang, {_votes_sql('w')} AS s FROM (SELECT doc_id, lang, {_W.replace('text', 'left(text, 1000)')} AS w FROM documents)), {_DETECT} SELECT doc_id, s[1].lang AS detected, {_ENSEMBLE} AS score FROM share")
def edu2(s, d):
    found = U.language_score(text(), F.col("lang"), U.stopword_detector())
    return docs(s, d).select("doc_id", found.alias("f")).select("doc_id", F.col("f.lang").alias("detected"), F.col("f.score").alias("score"))


_SPLIT = r"list_filter(list_transform(string_split_regex(text, '[.!?]'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 40)[1:20]"


@register("edu3_code_mix", f"WITH p AS (SELECT doc_id, lang, unnest({_SPLIT}) AS part FROM documents), v AS (SELECT doc_id, lang, {_votes_sql('w')} AS s FROM (SELECT doc_id, lang, {_W.replace('text', 'left(part, 1000)')} AS w FROM p)), {_DETECT}, m AS (SELECT doc_id, count(*) AS n, sum(({_ENSEMBLE} < 0.7)::INT) AS other FROM share GROUP BY doc_id) SELECT doc_id, coalesce(other > 0.3 * n, false) AS mixed FROM documents LEFT JOIN m USING (doc_id)")
def edu3(s, d):
    return docs(s, d).select("doc_id", U.is_code_mixed(text(), F.col("lang"), U.stopword_detector()).alias("mixed"))


@register("edu4_educational_score", f"{_PLAIN} SELECT doc_id, score FROM e3")
def edu4(s, d):
    return docs(s, d).select("doc_id", E.educational_score(text()).alias("score"))


@register("edu5_learner_level", f"{_PLAIN} SELECT doc_id, fk AS grade, level, audience FROM e5")
def edu5(s, d):
    level = E.learner_level(text())
    return docs(s, d).select("doc_id", E.readability_grade(text()).alias("grade"), level.alias("level")).withColumn("audience", E.audience(F.col("level")))


@register("edu6_vocabulary_ratios", f"{_PLAIN} SELECT doc_id, CASE WHEN usable THEN len(list_distinct(w)) / len(w) ELSE 0.5 END::DOUBLE AS type_token, CASE WHEN usable THEN len(list_filter(cw, lambda x: length(x) > 6)) / len(cw) ELSE 0.3 END::DOUBLE AS long_words FROM e2")
def edu6(s, d):
    return docs(s, d).select("doc_id", E.type_token_ratio(text()).alias("type_token"), E.long_word_ratio(text()).alias("long_words"))


_TRUST = f"len(list_filter({_list(E.TRUSTED)} || ['example'], lambda x: contains(lower(coalesce(url, '')), x))) > 0"


@register("edu7_trusted_source", f"SELECT page_id, {_TRUST} AS trusted FROM pages")
def edu7(s, d):
    return table(s, d, "pages").select("page_id", E.is_trusted(F.col("url"), [*E.TRUSTED, "example"]).alias("trusted"))


@register("edu8_source_boost", f"SELECT page_id, CASE WHEN {_TRUST} THEN least(page_id % 6 + 0.5, 5.0) ELSE page_id % 6 END::DOUBLE AS score FROM pages")
def edu8(s, d):
    return table(s, d, "pages").select("page_id", E.boosted((F.col("page_id") % 6).cast("double"), E.is_trusted(F.col("url"), [*E.TRUSTED, "example"])).alias("score"))


_GC = f"{_WORDS}, all5 AS (SELECT doc_id, unnest({_grams(5)}) AS gram FROM w), gc AS (SELECT gram, count(*) AS n FROM all5 GROUP BY gram)"


@register("edu9_gram_counts", f"{_GC} SELECT gram, n FROM gc ORDER BY n DESC, gram LIMIT 500000")
def edu9(s, d):
    return C.top_grams(C.gram_counts(docs(s, d), text()))


@register("edu10_memorization", f"{_GC}, per AS (SELECT doc_id, count(*) AS grams, sum((n >= 3)::INT)::BIGINT AS repeated FROM all5 JOIN gc USING (gram) GROUP BY doc_id) SELECT doc_id, coalesce(grams, 0) AS grams, coalesce(repeated, 0) AS repeated, CASE WHEN grams > 0 THEN repeated / grams ELSE 0.0 END::DOUBLE AS score FROM documents LEFT JOIN per USING (doc_id)")
def edu10(s, d):
    return C.memorization(docs(s, d), "doc_id", text())


@register("edu11_tier", f"{_PLAIN} SELECT doc_id, tier FROM e5")
def edu11(s, d):
    return E.measured(docs(s, d).select("doc_id", "text"), text()).select("doc_id", "tier")


_FUNNEL = rf"""{_GRAMS.replace("FROM documents)", "FROM (SELECT * REPLACE (" + _MASK + " AS text) FROM documents))", 1)}, src AS (SELECT doc_id, lang, {_MASK} AS text FROM documents), {_EDU},
o AS (SELECT d.doc_id, score, level, audience, tier, CASE WHEN length(d.text) NOT BETWEEN 200 AND 100000 THEN 'bad_length' WHEN d.doc_id NOT IN (SELECT min(doc_id) FROM documents WHERE length(text) BETWEEN 200 AND 100000 GROUP BY sha256(text)) THEN 'duplicate' WHEN hits >= 3 THEN 'toxic' WHEN d.doc_id IN (SELECT doc_id FROM hit) THEN 'contaminated' ELSE 'kept' END AS outcome FROM documents d JOIN e5 ON e5.doc_id = d.doc_id)"""


@register("edu12_audience_filter", f"{_FUNNEL} SELECT doc_id, score AS edu_score, level AS learner_level FROM o WHERE outcome = 'kept' AND level IN ('K1', '9-12')")
def edu12(s, d):
    return U.judged(docs(s, d), index(s, d), levels=("K1", "9-12")).where("outcome = 'kept'").select("doc_id", "edu_score", "learner_level")


@register("edu13_funnel", f"{_FUNNEL} SELECT x.outcome, count(o.doc_id) AS n FROM (SELECT unnest({_list(U.OUTCOMES)}) AS outcome) x LEFT JOIN o ON o.outcome = x.outcome GROUP BY x.outcome")
def edu13(s, d):
    return U.funnel(U.judged(docs(s, d), index(s, d)))


@register("edu13_tier_counts", f"{_FUNNEL} SELECT tier, learner_level, count(*) AS n FROM (SELECT tier, level AS learner_level FROM o WHERE outcome = 'kept') GROUP BY tier, learner_level")
def edu13_tiers(s, d):
    return U.judged(docs(s, d), index(s, d)).where("outcome = 'kept'").groupBy("tier", "learner_level").agg(F.count(F.lit(1)).alias("n"))


@register("edu14_ridge_scorer")
def edu14(s, d):
    rows = table(s, d, "embeddings").select("vec_id", "embedding", (F.col("label") / 2).alias("score"))
    return M.score_documents(rows, "embedding", M.train_student(rows, "embedding", "score", {}, scaled=True)).select("vec_id", "score", "quality")


# Annotations and features


_ANN = f"a0 AS (SELECT doc_id, lang, text, lower(text) AS low, length(text) AS n, {_WC} AS k FROM documents), a AS (SELECT doc_id, lang, text, ((n <= 5 * k)::INT + (k < 300)::INT + contains(low, 'the')::INT + contains(low, '!')::INT + (n <= 6 * k)::INT) AS quality_score, CASE WHEN n > 8 * k THEN 3 WHEN n > 5 * k AND n <= 7 * k THEN 2 WHEN n <= 5 * k THEN 1 ELSE 2 END AS difficulty_level, n > 7 * k AS vocab_complexity, contains(low, 'ingation') AS has_jargon, contains(low, '!') AS engagement, CASE WHEN contains(low, 'tion') THEN 'science' WHEN contains(low, 'eau') THEN 'math' WHEN contains(low, 'keit') THEN 'social_science' WHEN contains(low, 'ci') THEN 'language' ELSE 'other' END AS topic_label FROM a0)"


def _annotated(s, d):
    return docs(s, d).select("doc_id", "lang", C.rule_annotation(text()).alias("annotation"))


@register("ann1_prompt", "SELECT doc_id, replace(replace('" + C.PROMPT.replace("'", "''") + "', '{calibration}', ''), '{input_text}', left(text, 2000)) AS prompt FROM documents")
def ann1(s, d):
    return docs(s, d).select("doc_id", C.prompt(text()).alias("prompt"))


@register("ann2_rule_annotation")
def ann2(s, d):
    return _annotated(s, d).select("doc_id", F.to_json("annotation").alias("annotation"))


def _judge(question: str) -> str | None:
    """Stands in for a model: flags by words of the prompt, in a code fence; no reply about some texts, and an error about others."""
    body = question.split("Text:\n", 1)[1]
    if body.count("e") % 7 == 0:
        raise TimeoutError
    if body.count("e") % 7 == 1:
        return None
    return "```json\n" + json.dumps({"readability": {"elementary": len(body) < 900}, "topic": {"science": "on" in body, "math": False}}) + "\n```"


_LEFT = "left(text, 2000)"


@register("ann2_annotator", f"WITH p AS (SELECT doc_id, length({_LEFT}) AS n, (length({_LEFT}) - length(replace({_LEFT}, 'e', ''))) % 7 AS k, contains({_LEFT}, 'on') AS science FROM documents) SELECT doc_id, k > 1 AS answered, CASE WHEN k > 1 THEN (n < 900)::INT ELSE 0 END AS quality_score, CASE WHEN k > 1 AND science THEN 'science' ELSE 'other' END AS topic_label FROM p")
def ann2_annotator(s, d):
    rows = C.annotated(docs(s, d).select("doc_id", "text"), text(), _judge)
    return rows.select("doc_id", F.col("annotation").isNotNull().alias("answered"), C.quality_score(F.col("annotation")).alias("quality_score"), C.topic_label(F.col("annotation")).alias("topic_label"))


@register("fea1_quality", f"WITH {_ANN} SELECT doc_id, quality_score FROM a")
def fea1(s, d):
    return _annotated(s, d).select("doc_id", C.quality_score(F.col("annotation")).alias("quality_score"))


@register("fea2_difficulty", f"WITH {_ANN} SELECT doc_id, difficulty_level FROM a")
def fea2(s, d):
    return _annotated(s, d).select("doc_id", C.difficulty(F.col("annotation")).alias("difficulty_level"))


@register("fea3_topic", f"WITH {_ANN} SELECT doc_id, topic_label FROM a")
def fea3(s, d):
    return _annotated(s, d).select("doc_id", C.topic_label(F.col("annotation")).alias("topic_label"))


@register("fea4_features", f"WITH {_ANN} SELECT doc_id, quality_score, difficulty_level, vocab_complexity, has_jargon, engagement, topic_label, CASE WHEN doc_id % 5 = 0 THEN '' ELSE text END AS text FROM a")
def fea4(s, d):
    return C.feature_rows(_annotated(s, d), docs(s, d).where("doc_id % 5 <> 0"))


@register("fea5_distributions", f"WITH {_ANN} SELECT 'quality' AS kind, v AS value, count(doc_id) AS n FROM range(0, 6) t(v) LEFT JOIN a ON quality_score = v GROUP BY v UNION ALL SELECT 'difficulty', v, count(doc_id) FROM range(1, 4) t(v) LEFT JOIN a ON difficulty_level = v GROUP BY v")
def fea5(s, d):
    rows = C.feature_rows(_annotated(s, d), docs(s, d))
    part = lambda kind, c, lo, hi: C.distribution(rows, c, lo, hi).select(F.lit(kind).alias("kind"), "value", "n")
    return part("quality", "quality_score", 0, 5).unionByName(part("difficulty", "difficulty_level", 1, 3))


@register("fea5_topics", f"WITH {_ANN} SELECT topic_label, count(*) AS n FROM a GROUP BY topic_label")
def fea5_topics(s, d):
    return C.feature_rows(_annotated(s, d), docs(s, d)).groupBy("topic_label").agg(F.count(F.lit(1)).alias("n"))


# Models and topics


_BUCKET = "('0x' || left(md5(x), 4))::INT % 32"


@register("mdl1_encoder", f"WITH w AS (SELECT doc_id, list_transform({_W.replace('text', 'left(text, 512)')}, lambda x: {_BUCKET}) AS b FROM documents), c AS (SELECT doc_id, list_transform(range(32), lambda k: len(list_filter(b, lambda x: x = k))) AS n FROM w) SELECT doc_id, array_to_string(n, ',') AS counts, sqrt(list_sum(list_transform(n, lambda x: x * x)))::DOUBLE AS norm, len(n) AS dims FROM c")
def mdl1_encoder(s, d):
    """The encoder's vectors, given by whole counts and their length."""
    v = docs(s, d).select("doc_id", M.embedding(text(), 32, normalized=False).alias("n"))
    return v.select("doc_id", F.array_join(F.transform("n", lambda x: x.cast("long").cast("string")), ",").alias("counts"), F.sqrt(F.aggregate("n", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"), F.size("n").cast("long").alias("dims"))


@register("mdl1_training_rows", f"WITH {_ANN} SELECT doc_id, quality_score, vocab_complexity::INT AS vocab_complexity, engagement::INT AS engagement FROM a WHERE text <> ''")
def mdl1(s, d):
    return C.feature_rows(_annotated(s, d), docs(s, d)).where("text <> ''").select("doc_id", "quality_score", F.col("vocab_complexity").cast("int").alias("vocab_complexity"), F.col("engagement").cast("int").alias("engagement"))


def _student_rows(s, d):
    label = F.col("label")
    return table(s, d, "embeddings").select("vec_id", "embedding", (label / 2).alias("quality_target"), (label % 3).alias("difficulty_target"), (label % 2).alias("engagement_target"), (label > 4).cast("int").alias("vocabulary_target"))


@register("mdl2_student_scores")
def mdl2(s, d):
    rows = _student_rows(s, d)
    student = M.train_student(rows, "embedding", "quality_target", {"difficulty": "difficulty_target", "engagement": "engagement_target", "vocabulary": "vocabulary_target"})
    return M.score_documents(rows, "embedding", student).select("vec_id", "quality", "difficulty", "p_engagement", "p_vocabulary")


@register("mdl3_metrics", f"WITH {_ANN}, p AS (SELECT quality_score AS p, 5 * quality AS y FROM a JOIN labels USING (doc_id)), m AS (SELECT count(*) AS n, sum(abs(p - y)) AS e, sum((p - y) * (p - y)) AS r, sum(y) AS y1, sum(y * y) AS y2, sum((p = y)::INT) AS ok FROM p) SELECT n, e::BIGINT / n AS mae, 1 - r::BIGINT / (y2::BIGINT - y1::BIGINT * y1::BIGINT / n) AS r2, ok::BIGINT / n AS accuracy FROM m")
def mdl3(s, d):
    rows = _annotated(s, d).select("doc_id", C.quality_score(F.col("annotation")).cast("long").alias("p")).join(table(s, d, "labels"), "doc_id")
    return M.metrics(rows.withColumn("y", (5 * F.col("quality")).cast("long")), "p", "y")


@register("mdl4_clipped_scores", "SELECT vec_id, least(greatest(20 * embedding[1]::DOUBLE + 2, 0), 5)::DOUBLE AS quality FROM embeddings")
def mdl4(s, d):
    return table(s, d, "embeddings").select("vec_id", M.clipped(20 * F.get("embedding", F.lit(0)).cast("double") + 2).alias("quality"))


@register("clu1_assignment", "WITH c AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS k, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id < 10) SELECT vec_id, arg_min(k, list_distance(embedding::DOUBLE[], v)) AS topic FROM embeddings, c GROUP BY vec_id")
def clu1(s, d):
    rows = table(s, d, "embeddings")
    centroids = [r["embedding"] for r in rows.where("vec_id < 10").orderBy("vec_id").collect()]  # ten given centroids
    return M.nearest_centroid(rows, "embedding", centroids).select("vec_id", "topic")


@register("clu1_kmeans")
def clu1_kmeans(s, d):
    rows = table(s, d, "embeddings")
    return M.nearest_centroid(rows, "embedding", M.fit_topics(rows, "embedding", k=10)).select("vec_id", "topic")


_STATS = f"WITH {_ANN}, st AS (SELECT lang, doc_id % 10 AS topic, count(*) AS count, sum(quality_score)::BIGINT AS quality_sum, sum((difficulty_level = 1)::INT)::BIGINT AS level_1, sum((difficulty_level = 2)::INT)::BIGINT AS level_2, sum((difficulty_level = 3)::INT)::BIGINT AS level_3 FROM a GROUP BY 1, 2), lg AS (SELECT lang, count(*) AS topics, sum(count)::BIGINT AS docs, round(sum(quality_sum)::BIGINT / sum(count)::BIGINT, 3) AS avg_quality FROM st GROUP BY lang)"


def _stats(s, d):
    return C.topic_stats(C.feature_rows(_annotated(s, d), docs(s, d)).join(docs(s, d).select("doc_id", "lang"), "doc_id").withColumn("topic", F.col("doc_id") % 10), "lang", "topic", "quality_score", "difficulty_level")


@register("clu2_topic_stats", f"{_STATS} SELECT lang, topic, count, round(quality_sum / count, 3) AS avg_quality, level_1, level_2, level_3 FROM st")
def clu2(s, d):
    return _stats(s, d).select("lang", "topic", "count", F.round("avg_quality", 3).alias("avg_quality"), "level_1", "level_2", "level_3")


@register("clu3_language_index", f"{_STATS.replace('WITH ', 'WITH ' + _HEU[5:] + ', ', 1)}, rj AS (SELECT lang, 1 - sum(passes::INT) / count(*) AS reject_rate FROM hp GROUP BY lang) SELECT lang, topics, docs, avg_quality, reject_rate FROM lg JOIN rj USING (lang)")
def clu3(s, d):
    return C.index_totals(_stats(s, d), "lang").join(heu8(s, d).select("lang", "reject_rate"), "lang")


@register("clu4_corpus_totals", f"{_STATS} SELECT count(*) AS languages, sum(docs)::BIGINT AS docs, sum(topics)::BIGINT AS topics FROM lg")
def clu4(s, d):
    return C.corpus_totals(C.index_totals(_stats(s, d), "lang"))


@register("snk4_hive_index", "SELECT lang, doc_id % 10 AS topic, count(*) AS n_docs FROM documents GROUP BY 1, 2")
def snk4(s, d):
    path = S.scratch(s, "hive")
    S.write_hive(docs(s, d).withColumn("topic", F.col("doc_id") % 10), path)
    return s.read.parquet(path).groupBy("lang", F.col("topic").cast("long").alias("topic")).agg(F.count(F.lit(1)).alias("n_docs"))


@register("snk8_json_tiers", f"{_PLAIN} SELECT sink, tier, doc_id, text FROM e5, (SELECT unnest(['full', 'final', 'tiers']) AS sink) WHERE sink = 'full' OR hits < 3")
def snk8(s, d):
    rows = E.measured(docs(s, d).select("doc_id", "text"), text()).select("doc_id", "text", "tier", "toxic_hits")
    S.write_tiers(rows, path := S.scratch(s, "tiers"), "tier", F.col("toxic_hits") < 3)
    read = lambda sink: s.read.schema("doc_id BIGINT, text STRING, tier STRING").json(f"{path}/{sink}").select(F.lit(sink).alias("sink"), "tier", "doc_id", "text")
    return read("full").unionByName(read("final")).unionByName(read("tiers"))


@register("snk8_stats", f"{_PLAIN} SELECT tier, count(*) AS docs, sum((hits < 3)::INT)::BIGINT AS kept FROM e5 GROUP BY tier")
def snk8_stats(s, d):
    rows = E.measured(docs(s, d).select("doc_id", "text"), text()).select("doc_id", "tier", "toxic_hits")
    S.write_tiers(rows, path := S.scratch(s, "tiers"), "tier", F.col("toxic_hits") < 3)
    return s.read.schema("tier STRING, docs BIGINT, kept BIGINT").json(f"{path}/stats")


@register("snk9_annotation_lines", f"WITH {_ANN} SELECT doc_id, lang, quality_score FROM a")
def snk9(s, d):
    path = S.scratch(s, "annotations")
    S.write_json(_annotated(s, d), path, ["lang"])
    back = s.read.schema(f"doc_id BIGINT, annotation {C.ANNOTATION}, lang STRING").json(path)
    return back.select("doc_id", "lang", C.quality_score(F.col("annotation")).alias("quality_score"))
