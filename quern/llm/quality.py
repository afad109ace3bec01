"""Repetition coverage: the share of a document that repeats itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import kernels as K
from quern.llm import store

#: Share of word characters that may lie in repeated n-grams, by n, and in repeated lines.
LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20

_NEWLINE = 10


def _measure(buf: np.ndarray, off: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """Per row: word characters, those in repeated n-grams for each length, then those in repeated lines."""
    n = len(off) - 1
    w = K.words(buf, off)
    chars = K.char_counts(buf, w.start, w.end)
    total = np.bincount(w.row, chars, n).astype(np.int64)
    out = [total]
    tag = K.mix(w.row.astype(np.uint64) + np.uint64(1))
    for k in lengths:
        at, g = K.ngrams(w.hash, w.row, k)
        again = at[K.repeated(g ^ tag[at])]
        m = len(w.hash) + 1
        inside = np.cumsum(np.bincount(again, minlength=m) - np.bincount(again + k, minlength=m))[:-1] > 0
        out.append(np.bincount(w.row[inside], chars[inside], n).astype(np.int64))
    # Lines as sequences of words: a line's key is made of its words alone.
    line_of_byte = np.flatnonzero(buf == _NEWLINE)
    line = np.searchsorted(line_of_byte, w.start)
    if len(w.hash):
        fresh = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (w.row[1:] != w.row[:-1])]))
        ends = np.append(fresh[1:], len(w.hash))
        key = K.spans_hash(w.hash >> np.uint64(8), fresh, ends) ^ tag[fresh]
        bad = K.repeated(key)
        inside = np.repeat(bad, ends - fresh)
        out.append(np.bincount(w.row[inside], chars[inside], n).astype(np.int64))
    else:
        out.append(np.zeros(n, np.int64))
    return out


def repetition_coverage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: dict[int, float] = LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """One row for each row of docs: id_col, word_chars, dup{n}_chars for each n of limits, dup_line_chars and keep.

    A word is a lower-cased run of ASCII letters, digits and underscores and of any
    characters beyond ASCII. dup{n}_chars counts the characters of the words inside an
    n-gram that occurred before in the document, each word once; dup_line_chars those in
    lines whose words, in order, are those of an earlier line. keep is false if any such
    count, divided by word_chars, exceeds its limit.

    A null, empty or wordless text has 0 everywhere and is kept: nothing repeats in it. A
    null id stays null. Repeated rows are measured each on its own; an empty table gives an
    empty one; other columns of docs are ignored. Whole texts of any length are measured.
    One scan, no shuffle: the memory of a worker is bounded by a block of text, or by the
    longest document.
    """
    lengths = sorted(limits)
    names = ["word_chars", *(f"dup{k}_chars" for k in lengths), "dup_line_chars"]
    src = docs.select(F.col(id_col).alias("__id"), F.lower(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.utf8(batch.column(1))
            for lo, hi in K.blocks(off):
                got = _measure(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], lengths)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, got)], ["__id", *names])

    kind = src.schema["__id"].dataType.simpleString()
    got = src.mapInArrow(K.tidy(run), f"__id {kind}, " + ", ".join(f"{c} long" for c in names))
    keep = F.col("dup_line_chars") <= F.lit(line_limit) * F.col("word_chars")
    for k in lengths:
        keep = keep & (F.col(f"dup{k}_chars") <= F.lit(limits[k]) * F.col("word_chars"))
    return got.withColumn("keep", keep).withColumnRenamed("__id", id_col)


def keep_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: dict[int, float] = LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """The rows of docs whose repetition stays within the limits, with their columns; see repetition_coverage.

    The verdict is computed beside the row in one pass, so repeated ids do no harm and nothing is joined.
    """
    lengths = sorted(limits)
    bound = [limits[k] for k in lengths] + [line_limit]
    schema = docs.schema
    carried = docs.select("*", F.lower(text_col).alias(store.unused(docs.columns, "__lower")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.utf8(batch.column(batch.num_columns - 1))
            for lo, hi in K.blocks(off):
                total, *dup = _measure(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], lengths)
                good = np.ones(hi - lo, bool)
                for d, most in zip(dup, bound):
                    good &= d <= most * total
                part = batch.slice(lo, hi - lo).filter(pa.array(good))
                yield pa.RecordBatch.from_arrays(part.columns[:-1], batch.schema.names[:-1])

    return carried.mapInArrow(K.tidy(run), schema)
