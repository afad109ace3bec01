"""Cheap quality heuristics as expressions: function words, readability, script, repetition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T

#: Function words by language; none for those written without blanks.
STOPWORDS: dict[str, list[str]] = {
    lang: sorted(set(words.split()))
    for lang, words in {
        "en": "a about above after again all an and are as at be because been before being below between both but by can could dare did do does during each every few for from further had has have he her here him his how i if in into is it its just may me might more most my myself need no nor not of off on once only or other ought our ours out over own same shall she should so some such than that the their them then there these they this those through to too under up used very was we were what when where which while who whom why will with would you your",
        "fr": "au autre aussi aux avec bien ce cette comme dans de des du en entre est et il je la le les leur mais mon même ne nous ou par pas plus pour que qui sa se ses son sur ton tout un une vous",
        "de": "aber als an auch auf aus bei das dem den der des die diese ein eine er es für hat ich in ist kann mit nach nicht noch nur oder sein sich sie so und von vor war wenn werden wie wir zu über",
        "es": "al como con cuando de del desde donde el en entre es esta este fue ha hasta hay la las le lo los me muy más no o pero por porque que quien se ser si sin sobre son su también todo un una y ya",
        "ar": "أن إذا إلى التي الذي بعد بين ثم حتى ذلك على عن عند في قد كان كل لا لم ما مع من هذا هذه هو هي",
        "ru": "а бы в все вы да для его ее же за и из к как мы на не но он она от по с так то уже что это я",
        "tr": "ama ayrıca bir bu bunu ben da daha de en gibi hem her ile için kadar ki ne o olan olarak sonra var ve ya çok",
        "hi": "इस एक और कि की के को का तो था नहीं ने पर भी में यह या से है हैं",
        "nl": "aan als bij dan dat de dit door een en er het in is maar met niet nog om ook op te uit van voor wat wel zijn",
        "pl": "ale by być co czy do go i ja jak jego jej jest już na nie o od po się tak tego ten to ty w z za że",
        "it": "a anche che ci come con da di fra gli i il in io la le lo ma ne non per più se si su tra un uno una è",
        "sv": "att av de den det en ett för från han har hon i inte jag kan med men och om på ska som så till var vi är",
        "pt": "a ao as com como da de do e ela ele em eu foi mais mas nos não o os para por que se também um uma é",
    }.items()
}
UNSPACED = ("zh", "ja")

#: Scripts of languages, as Java names them.
SCRIPTS: dict[str, str] = dict.fromkeys("bg ru uk".split(), "Cyrillic") | dict.fromkeys("ar fa ur".split(), "Arabic") | dict.fromkeys("ca cs da de en es eu fr hr hu id it nl pl pt sl so sv tl tr vi wo yo".split(), "Latin") | {"el": "Greek", "hi": "Devanagari", "gu": "Gujarati", "ta": "Tamil", "bn": "Bengali", "am": "Ethiopic", "th": "Thai", "ko": "Hangul", "ja": "Han", "zh": "Han"}
_CLASS = {s: rf"\p{{Is{s}}}" for s in set(SCRIPTS.values())} | {"Han": r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}", "Hangul": r"\p{IsHangul}\p{IsHan}"}
#: Signs that say nothing about a script.
_NEUTRAL = r"""[\s\p{Nd}.,;:!?\-()\[\]{}"'/\\@#$%^&*+=<>~`|_]"""
_STOP = ".!?。！？"


@dataclass(frozen=True)
class Limits:
    """Bounds of the gate."""

    stopwords: tuple[float, float] = (0.03, 0.60)
    grade: tuple[float, float] = (1.0, 18.0)
    script: float = 0.60
    distinct: float = 0.30
    sentence: tuple[float, float] = (3.0, 80.0)
    letters: tuple[float, float] = (2.0, 20.0)


def _among(w: Column, known: list[str]) -> Column:
    return F.size(F.filter(w, lambda x: x.isin(known)))


def stopword_hits(w: Column, lang: Column) -> Column:
    """How many words are function words of the language; null where there is no list."""
    hit = F.lit(None).cast("int")
    for code, stops in STOPWORDS.items():
        hit = F.when(lang == code, _among(w, stops)).otherwise(hit)
    return hit


def stopword_density(w: Column, lang: Column) -> Column:
    return F.when(F.size(w) > 0, F.coalesce(stopword_hits(w, lang) / F.size(w), F.lit(0.0))).otherwise(0.0)


def sentences(c: Column, stop: str = _STOP) -> Column:
    """Parts between sentence marks (the characters of stop) that aren't blank."""
    return F.regexp_count(c, F.lit(rf"[^{T.SPACE}{stop}][^{stop}]*+"))


def syllables(w: Column) -> Column:
    """Vowel groups, at least one in a word, without a silent e at its end; counted over all words in one go."""

    def count(t: Column) -> Column:
        groups = F.regexp_count(t, F.lit("[aeiouy]++"))
        without = F.regexp_count(t, F.lit("(?<![^ ])[^aeiouy ]++(?![^ ])"))
        silent = F.regexp_count(t, F.lit("(?<![^ ])[^aeiouy ]*+[aeiouy]++[^aeiouy ]++[^ ]*+(?<=e)"))
        return groups + without - silent

    return T.let(F.lower(F.array_join(w, " ")), count)


def grade(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Flesch-Kincaid."""
    return 0.39 * (n_words / n_sentences) + 11.8 * (n_syllables / n_words) - 15.59


def _grade_of(w: Column, n_sentences: Column) -> Column:
    return F.when(F.size(w) < 10, -1.0).otherwise(grade(F.size(w), F.greatest(F.lit(1), n_sentences), syllables(w)))


def flesch_kincaid(c: Column) -> Column:
    """Grade of an English text; -1 below ten words."""
    return T.let(T.cased_words(c), lambda w: _grade_of(w, sentences(c)))


def characters(w: Column) -> Column:
    return F.length(F.array_join(w, ""))


def _sentence_length_of(w: Column, n_sentences: Column) -> Column:
    return F.when(F.size(w) < 5, 0.0).otherwise(F.size(w) / F.greatest(F.lit(1), n_sentences))


def sentence_length(c: Column) -> Column:
    """Words in a sentence; 0 below five words."""
    return T.let(T.cased_words(c), lambda w: _sentence_length_of(w, sentences(c)))


def _letters_of(w: Column) -> Column:
    return F.when(F.size(w) < 5, 0.0).otherwise(characters(w) / F.size(w))


def letters_in_word(c: Column) -> Column:
    return T.let(T.cased_words(c), _letters_of)


def script_sample(c: Column, first: int = 500) -> Column:
    return F.substring(F.regexp_replace(c, _NEUTRAL, ""), 1, first)


def _script_share(sample: Column, lang: Column) -> Column:
    out = F.lit(1.0)
    for script in sorted(set(SCRIPTS.values())):
        codes = [k for k, v in SCRIPTS.items() if v == script]
        share = F.when(F.length(sample) == 0, 0.0).otherwise(F.length(F.regexp_replace(sample, f"[^{_CLASS[script]}]", "")) / F.length(sample))
        out = F.when(lang.isin(codes), share).otherwise(out)
    return out


def script_consistency(c: Column, lang: Column, first: int = 500) -> Column:
    """Share of the first letters that belong to the language's script; 1 for unknown languages, 0 without letters."""
    return T.let(script_sample(c, first), lambda sample: _script_share(sample, lang))


def repetition_ratio(w: Column, n: int = 5) -> Column:
    """Distinct n-grams by all; 1 below ten words."""
    return F.when(F.size(w) < 10, 1.0).otherwise(T.let(T.gram_hashes(w, n), lambda g: F.size(F.array_distinct(g)) / F.size(g)))


#: Columns that measured adds.
MEASURES = ["stopword_density", "grade", "sentence_length", "letters_in_word", "script_consistency", "repetition_ratio", "passes"]


def measured(df: DataFrame, c: Column, lang: Column, limits: Limits = Limits()) -> DataFrame:
    """df with MEASURES: every measure of the gate, and its verdict.

    A language without function words skips that test; so does a null one, which has no script either. A null text is
    measured as an empty one. Words, sentences and the sample of letters are computed once, in a projection of their own. Columns of df with such names are replaced.
    """
    c = F.coalesce(c, F.lit(""))
    rows = df.select("*", lang.alias("__lang"), T.words(c).alias("__w"), T.cased_words(c).alias("__cw"), sentences(c).alias("__n"), script_sample(c).alias("__sample"))
    w, cw, n = F.col("__w"), F.col("__cw"), F.col("__n")
    rows = rows.select(
        *[x for x in rows.columns if x not in MEASURES],
        stopword_density(w, F.col("__lang")).alias("stopword_density"),
        _grade_of(cw, n).alias("grade"),
        _sentence_length_of(cw, n).alias("sentence_length"),
        _letters_of(cw).alias("letters_in_word"),
        F.coalesce(_script_share(F.col("__sample"), F.col("__lang")), F.lit(1.0)).alias("script_consistency"),
        repetition_ratio(w).alias("repetition_ratio"),
    )
    known = F.coalesce(F.col("__lang").isin(list(STOPWORDS)), F.lit(False))
    stop_ok = ~known | F.col("stopword_density").between(*limits.stopwords)
    size, fk = F.col("sentence_length"), F.col("grade")
    other = (size <= 0) | (size.between(*limits.sentence) & F.col("letters_in_word").between(*limits.letters))
    readable = F.when(F.col("__lang") == "en", (fk < 0) | fk.between(*limits.grade)).otherwise(other)
    verdict = stop_ok & readable & (F.col("script_consistency") >= limits.script) & (F.col("repetition_ratio") >= limits.distinct)
    return rows.withColumn("passes", verdict).drop("__lang", "__w", "__cw", "__n", "__sample")
