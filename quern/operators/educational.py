"""The educational corpus: what becomes of each document, and its labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import education as E
from quern.functions import heuristics as H
from quern.functions import text as T
from quern.operators import decontamination as D
from quern.sources.writers import stored

#: A detector gives an array of structs (lang, score), one for each of its models, of a text column.
Detector = Callable[[Column], Column]

#: Why documents go, in the order of the tests.
OUTCOMES = ("bad_length", "duplicate", "language", "code_mix", "toxic", "contaminated", "audience", "kept")


def language_score(c: Column, target: Column, detector: Detector | None = None) -> Column:
    """Struct of lang and score: the mean over the detector's models, lowered where one is unsure. Without a detector, the target and 1.

    A model that finds another language than target scores 0; a null text has no score.
    """
    if detector is None:
        return F.struct(target.alias("lang"), F.lit(1.0).alias("score"))

    def ensemble(votes: Column) -> Column:
        scores = F.transform(votes, lambda v: F.when(v["lang"] == target, v["score"]).otherwise(0.0))
        mean = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(scores), F.lit(1))
        return F.struct(F.get(votes, F.lit(0))["lang"].alias("lang"), F.when(F.exists(scores, lambda x: x < 0.5), mean * 0.7).otherwise(mean).alias("score"))

    return T.let(detector(F.substring(c, 1, 1000)), ensemble)


def stopword_detector(languages: tuple[str, ...] = ("en", "fr", "de", "es")) -> Detector:
    """Two models from function words: the share of hits that the best language has, and the logistic function of its lead over the next.

    A detector that needs no library. Ties go to the language named first; a text without function words has score 0 in the first and 0.5 in the second.
    """

    def detect(c: Column) -> Column:
        def votes(w: Column) -> Column:
            hits = F.array(*[F.struct((-F.size(F.filter(w, lambda x: x.isin(H.STOPWORDS[lang])))).alias("n"), F.lit(i).alias("at"), F.lit(lang).alias("lang")) for i, lang in enumerate(languages)])
            return T.let(F.array_sort(hits), two)

        def two(s: Column) -> Column:
            total = F.aggregate(s, F.lit(0), lambda a, x: a - x["n"])
            lead = s[1]["n"] - s[0]["n"]
            one = lambda score: F.struct(s[0]["lang"].alias("lang"), score.alias("score"))
            return F.array(one(F.when(total > 0, -s[0]["n"] / total).otherwise(F.lit(0.0))), one(F.round(1 / (1 + F.exp(-lead.cast("double"))), 9)))

        return T.let(T.words(c), votes)

    return detect


def is_code_mixed(c: Column, target: Column, detector: Detector | None = None, most: int = 20, share: float = 0.3) -> Column:
    """Whether more than share of the first long sentences are in another language; never without a detector."""
    if detector is None:
        return F.lit(False)
    long = F.slice(F.filter(F.transform(F.split(c, r"[.!?]", -1), T.strip), lambda s: F.length(s) > 40), 1, most)
    foreign = F.filter(long, lambda s: language_score(s, target, detector)["score"] < 0.7)
    return (F.size(long) > 0) & (F.size(foreign) > share * F.size(long))


def judged(df: DataFrame, index: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", detector: Detector | None = None, levels: tuple[str, ...] = (), trusted: Column | None = None, n: int = D.N) -> DataFrame:
    """id_col, outcome (one of OUTCOMES), edu_score, learner_level, audience and tier of every row of df.

    Duplicates are found among texts of a fit length before anything else is tested, so a copy of a
    document that a later test rejects still counts as one. Decontamination and scores see the text
    with personal data masked, duplicates the text before.

    Every row has one outcome, whatever its id. Of equal texts the one with the least id isn't a duplicate; a null id
    comes last. Rows that are equal in id and text share an outcome. A null text has a bad length, a null language fails the
    language test. An empty table gives an empty one; other columns are ignored.
    """
    c, lang = F.col("__text"), F.col("__lang")
    rows = df.select(F.col(id_col), F.col(lang_col).alias("__lang"), T.clean(F.col(text_col)).alias("__text"), (F.lit(False) if trusted is None else trusted).alias("__source"))
    rows = rows.withColumn("__masked", T.mask_personal(c)).withColumn("__fit", T.length_status(c) == "ok")
    marked = D.with_hits(rows, index, id_col, F.col("__masked"), n, F.col("__fit"), "__hit")
    found = language_score(c, lang, detector)
    speech = F.when(lang.isNull() | (found["lang"] != lang) | (found["score"] < 0.8), "language").when(is_code_mixed(c, lang, detector), "code_mix")
    kept = E.measured(marked, F.col("__masked"), F.col("__source")).select(id_col, "__fit", "__hit", T.content_hash(c).alias("__hash"), speech.alias("__speech"), E.toxic_hits(c).alias("__toxic"), "edu_score", "learner_level", "audience", "tier")
    kept = stored(kept.withColumn("__key", F.xxhash64(id_col, "__hash")), "judged")  # no texts
    first = kept.where("__fit").groupBy("__hash").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col), F.col("__key").alias("k"))).alias("x")).select(F.col("x.k").alias("__key"), F.lit(True).alias("__first"))
    outcome = (
        F.when(~F.col("__fit"), "bad_length")
        .when(F.col("__first").isNull(), "duplicate")
        .when(F.col("__speech").isNotNull(), F.col("__speech"))
        .when(F.col("__toxic") >= 3, "toxic")
        .when(F.col("__hit"), "contaminated")
    )
    if levels:
        outcome = outcome.when(~F.col("learner_level").isin(*levels), "audience")
    return kept.join(first, "__key", "left").select(id_col, outcome.otherwise("kept").alias("outcome"), "edu_score", "learner_level", "audience", "tier")


def funnel(rows: DataFrame) -> DataFrame:
    """Documents by outcome, 0 where there are none."""
    spine = rows.sparkSession.createDataFrame([(o,) for o in OUTCOMES], "outcome string")
    return spine.join(rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")), "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))
