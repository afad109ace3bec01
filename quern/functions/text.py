"""Text expressions: normalisation, words, n-grams, masks, hashes. Column in, Column out."""

from __future__ import annotations

import importlib.util
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of letters, digits and underscores of any script; combining marks separate.
WORD = r"[\p{L}\p{N}_]+"
#: What Python's str.split() takes for white space, beyond \s of Java.
SPACE = r"\s\u001c-\u001f\u0085   -     　"

#: Inside a character class: what isn't white space. Frequent characters are told by two ranges, and a blank by \S, before the long list is asked.
BLACK = rf"!-~¡-ᙿ[\S&&[^{SPACE[2:]}]]"

_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """Unicode NFKC, which Spark lacks."""
    return F.pandas_udf(_nfkc, "string")(c)


def _beyond_ascii(c: Column) -> Column:
    """NFKC of what has a character beyond ASCII, which alone goes to Python; c elsewhere."""
    return F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def _repaired(s: pd.Series) -> pd.Series:
    from ftfy import fix_text

    return s.map(lambda t: None if t is None else fix_text(unicodedata.normalize("NFKC", t)))


def strip(c: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def _tidy(c: Column) -> Column:
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ")
    c = F.regexp_replace(c, r" {2,}", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def normalize(c: Column) -> Column:
    """NFKC, control characters to blanks, runs of blanks to one, of line feeds to two, ends stripped. Null is empty.

    ASCII text, which NFKC leaves as it is, doesn't leave the JVM.
    """
    return _tidy(_beyond_ascii(F.coalesce(c, F.lit(""))))


def clean(c: Column) -> Column:
    """normalize, with ftfy's repairs after NFKC where the driver has that library; all text goes to Python then."""
    if importlib.util.find_spec("ftfy") is None:
        return normalize(c)
    return _tidy(F.pandas_udf(_repaired, "string")(F.coalesce(c, F.lit(""))))


def length_status(c: Column, least: int = 200, most: int = 100_000) -> Column:
    """too_short, too_long or ok; a null text is too short."""
    return F.when(c.isNull() | (F.length(c) < least), "too_short").when(F.length(c) > most, "too_long").otherwise("ok")


def words(c: Column) -> Column:
    """Lower-cased words, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), 0)


def cased_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), 0)


def word_count(c: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(c, F.lit(rf"[{BLACK}]++"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: a lambda computes again, for each element, what is written inside it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ngrams(w: Column, n: int) -> Column:
    """All n-grams of an array of words, joined by blanks, with repeats."""
    grams = lambda x: F.when(F.size(x) >= n, F.transform(F.sequence(F.lit(1), F.size(x) - n + 1), lambda i: F.array_join(F.slice(x, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return let(w, grams)


def gram_hashes(w: Column, n: int) -> Column:
    """64-bit hashes of all n-grams of an array of words, with repeats: words are hashed once, and their hashes together."""
    grams = lambda h: F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(1), F.size(h) - n + 1), lambda i: F.xxhash64(F.slice(h, i, n)))).otherwise(F.array().cast("array<bigint>"))
    return let(F.transform(w, lambda x: F.xxhash64(x)), grams)


def ngram_set(w: Column, n: int) -> Column:
    return F.array_distinct(ngrams(w, n))


def flatten_lines(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


_MAIL = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
_PHONE = r"\b(\+?\d[\d\s\-().]{7,}\d)\b"
_SSN = r"\b\d{3}-\d{2}-\d{4}\b"


def mask_personal(c: Column) -> Column:
    """E-mail addresses, phone numbers, then social security numbers; the second pattern takes most of the third's."""
    for pattern, mask in ((_MAIL, "[EMAIL]"), (_PHONE, "[PHONE]"), (_SSN, "[SSN]")):
        c = F.regexp_replace(c, pattern, mask)
    return c


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def fallback_id(c: Column) -> Column:
    """For documents without an id: MD5 of the first 200 characters."""
    return F.md5(F.substring(c, 1, 200))


def stripped_hash(c: Column) -> Column:
    return F.sha2(strip(c), 256)


def snippet(text: Column, word: Column, around: int = 200, otherwise: int = 400) -> Column:
    """Characters around the first place of word in the lower-cased text, or the beginning."""
    at = F.instr(F.lower(text), word)
    begin = F.greatest(at - around, F.lit(1))
    return F.when((at > 0) & word.isNotNull(), F.substring(text, begin, at - begin + around)).otherwise(F.substring(text, 1, otherwise))


def fenced_json(c: Column) -> Column:
    """The JSON in a reply: without a code fence, and without the word json after it."""
    inner = F.regexp_extract(c, r"(?s)```(.*?)(?:```|\z)", 1)
    body = F.when(F.instr(c, "```") > 0, inner).otherwise(c)
    return strip(F.regexp_replace(strip(body), r"^json", ""))


def dataset_name(prefix: str, languages: Column) -> Column:
    """One name for a set of languages, whatever their order."""
    return F.concat(F.lit(prefix), F.array_join(F.array_sort(languages), "-"))
