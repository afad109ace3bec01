"""Rules of the educational corpus: toxicity, educational score, learner level, trusted sources, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import heuristics as H
from quern.functions import text as T


def _any(words: str) -> str:
    return rf"(?i)\b({'|'.join(words.split(', '))})\b"


TOXIC = [
    _any("ass, bastard, bitch, cunt, damn, fuck, hell, shit"),
    _any(r"kill\s+your?self, kys, suicide\s+method"),
    _any("ch[i1]nk, f[a4]gg[o0]t, n[i1]gg[ae]r, sp[i1]c"),
    _any("molest, pedophil, rape"),
    _any(r"al.qaeda, isis, terrorism\s+guide"),
]
POSITIVE = _any("biology, chapter, chemistry, concept, definition, example, exercise, experiment, explain, formula, geography, grammar, history, homework, knowledge, learn, lesson, literature, math, physics, science, study, teach, textbook, theorem, understand, vocabulary")
NEGATIVE = _any("adult, advertisement, buy now, casino, click here, coupon, gambling, limited offer, promo, subscribe, xxx")
TRUSTED = sorted("bbc.co.uk/cbbc britannica.com ducksters.com khanacademy.org kidsnewsroom.org nationalgeographic.com nature.com newsela.com pbs.org readworks.org scholastic.com sciencedaily.com smithsonianmag.com wikipedia.org".split())
#: What ends a sentence.
_STOP = ".!?"
LEVELS = [("K1", 1), ("2-3", 3), ("4-5", 5), ("6-8", 8), ("9-12", 12)]


def toxic_hits(c: Column) -> Column:
    """How many kinds of toxic phrases occur."""
    return sum((c.rlike(p).cast("int") for p in TOXIC[1:]), c.rlike(TOXIC[0]).cast("int"))


def toxicity(c: Column) -> Column:
    return F.least(toxic_hits(c) / 3, F.lit(1.0))


def _words_between(c: Column) -> Column:
    """Words between white space and sentence marks."""
    return F.regexp_count(c, F.lit(rf"[[{T.BLACK}]&&[^{_STOP}]]++"))


def _mean_sentence(words: Column, sentences: Column) -> Column:
    """Mean words of the sentences that aren't blank; null without any."""
    return F.when(sentences > 0, words / sentences)


def _score(c: Column, n: Column, mean: Column) -> Column:
    per = F.greatest(n / 50, F.lit(1.0))
    raw = (
        F.least(F.regexp_count(c, F.lit(POSITIVE)) / per, F.lit(2.5))
        - F.least(F.regexp_count(c, F.lit(NEGATIVE)) / per, F.lit(2.0))
        + F.when(mean.between(10, 25), 1.0).when((mean < 5) | (mean > 50), -0.5).otherwise(0.0)
        + F.when(c.rlike(r"\n#+\s"), 0.5).otherwise(0.0)
        + F.when(c.rlike(r"\d+\."), 0.3).otherwise(0.0)
        + F.when(c.rlike(r"(?i)\bfigure\b|\btable\b"), 0.3).otherwise(0.0)
    )
    return F.when(n == 0, 0.0).otherwise(F.least(F.greatest(raw, F.lit(0.0)), F.lit(5.0)))


def educational_score(c: Column) -> Column:
    """0 to 5: keyword density, sentence length, headings, lists, figures."""
    counts = F.struct(T.word_count(c).alias("n"), _words_between(c).alias("k"), H.sentences(c, _STOP).alias("s"))
    return T.let(counts, lambda x: _score(c, x["n"], _mean_sentence(x["k"], x["s"])))


def _usable(w: Column, n: Column) -> Column:
    return (F.size(w) > 0) & (n > 0)


def _grade(w: Column, n: Column) -> Column:
    return F.when(_usable(w, n), H.grade(F.size(w), n, H.syllables(w))).otherwise(8.0)


def _word_length(w: Column, n: Column) -> Column:
    return F.when(_usable(w, n), H.characters(w) / F.size(w)).otherwise(5.0)


def readability_grade(c: Column) -> Column:
    return T.let(T.cased_words(c), lambda w: _grade(w, H.sentences(c, _STOP)))


def mean_word_length(c: Column) -> Column:
    return T.let(T.cased_words(c), lambda w: _word_length(w, H.sentences(c, _STOP)))


def _level(fk: Column, length: Column) -> Column:
    out = F.when((fk <= 1) | (length <= 3.5), "K1")
    for name, most in LEVELS[1:]:
        out = out.when(fk <= most, name)
    return out.otherwise("Adult")


def learner_level(c: Column) -> Column:
    one = lambda w: T.let(F.struct(_grade(w, H.sentences(c, _STOP)).alias("g"), _word_length(w, H.sentences(c, _STOP)).alias("n")), lambda s: _level(s["g"], s["n"]))
    return T.let(T.cased_words(c), one)


#: Columns that measured adds.
MEASURES = ["toxic_hits", "edu_score", "grade", "learner_level", "audience", "tier"]


def measured(df: DataFrame, c: Column, trusted: Column | None = None) -> DataFrame:
    """df with MEASURES of a text: kinds of toxic phrases, educational score (raised for a trusted source), grade, learner level, its audience, tier.

    A null text is measured as an empty one, which has score 0 and the middle level. Words and sentences are computed
    once, in a projection of their own. Columns of df with such names are replaced.
    """
    c = F.coalesce(c, F.lit(""))
    rest = [x for x in df.columns if x not in MEASURES]
    rows = df.select(*rest, (F.lit(False) if trusted is None else trusted).alias("__trusted"), c.alias("__c"))
    rows = rows.select("*", T.cased_words(F.col("__c")).alias("__cw"), H.sentences(F.col("__c"), _STOP).alias("__n"), T.word_count(F.col("__c")).alias("__words"), _words_between(F.col("__c")).alias("__between"), toxic_hits(F.col("__c")).alias("toxic_hits"))
    w, n, c = F.col("__cw"), F.col("__n"), F.col("__c")
    rows = rows.select(*rest, "toxic_hits", boosted(_score(c, F.col("__words"), _mean_sentence(F.col("__between"), n)), F.col("__trusted")).alias("edu_score"), _grade(w, n).alias("grade"), _word_length(w, n).alias("__length"))
    rows = rows.withColumn("learner_level", _level(F.col("grade"), F.col("__length"))).drop("__length")
    return rows.withColumn("audience", audience(F.col("learner_level"))).withColumn("tier", tier(F.col("learner_level"), F.col("toxic_hits") == 0, F.col("edu_score")))


def audience(level: Column) -> Column:
    return F.when(level.isin("K1", "2-3", "4-5"), "kids").when(level.isin("6-8", "9-12"), "teens").otherwise("adults")


def type_token_ratio(c: Column) -> Column:
    return T.let(T.words(c), lambda w: F.when(_usable(w, H.sentences(c, _STOP)), F.size(F.array_distinct(w)) / F.size(w)).otherwise(0.5))


def long_word_ratio(c: Column, longer: int = 6) -> Column:
    return T.let(T.cased_words(c), lambda w: F.when(_usable(w, H.sentences(c, _STOP)), F.size(F.filter(w, lambda x: F.length(x) > longer)) / F.size(w)).otherwise(0.3))


def is_trusted(url: Column, domains: list[str] = TRUSTED) -> Column:
    """Whether the lower-cased url has a domain anywhere in it."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.exists(F.array(*map(F.lit, domains)), lambda d: F.contains(low, d))


def boosted(score: Column, trusted: Column, by: float = 0.5) -> Column:
    return F.when(trusted, F.least(score + by, F.lit(5.0))).otherwise(score)


def tier(level: Column, safe: Column, score: Column, high: float = 4.0, mid: float = 3.0) -> Column:
    return F.when(level.isin("K1", "2-3", "4-5") & safe, "kids").when(score >= high, "edu_high").when(score >= mid, "edu_mid").otherwise("general")
