"""Checks of packed chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import decontamination as D


def wrong_lengths(chunks: DataFrame, ids: str, length: int) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.sum((F.size(ids) != length).cast("long")).alias("wrong"))


def outside_vocabulary(chunks: DataFrame, ids: str, size: int) -> DataFrame:
    """Ids below 0 or beyond the vocabulary."""
    bad = F.size(F.filter(ids, lambda x: (x < 0) | (x >= size)))
    return chunks.agg(F.sum(F.size(ids)).alias("tokens"), F.sum(bad).alias("outside"))


def decode_words(chunks: DataFrame, keys: list[str], ids: str, vocabulary: DataFrame) -> DataFrame:
    """keys and text: the words that the ids of a word vocabulary stand for, joined by blanks."""
    rows = chunks.select(*keys, F.posexplode(ids).alias("__pos", "id")).join(vocabulary.select("id", "word"), "id")
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "word"))), lambda x: x["word"]), " ").alias("text"))


def recheck(decoded: DataFrame, keys: list[str], index: DataFrame, n: int = D.N) -> DataFrame:
    """Chunks, and those whose text still shares an n-gram with the index."""
    rows = decoded.withColumn("__key", F.to_json(F.struct(*keys)))
    hit = D.contaminated_ids(rows, index, "__key", F.col("text"), n)
    return rows.agg(F.count(F.lit(1)).alias("chunks")).crossJoin(hit.agg(F.count(F.lit(1)).alias("contaminated")))


def summary(chunks: DataFrame, length: int, by: list[str] = ()) -> DataFrame:
    """Chunks and tokens, by the columns of by."""
    return chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("chunks")).withColumn("tokens", F.col("chunks") * length)
