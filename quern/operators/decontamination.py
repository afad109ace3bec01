"""Benchmark decontamination: an n-gram index, and what of a corpus overlaps with it.

Words are hashed once and n-grams rolled from the hashes of their words, 96 bits in all, so no gram of
the corpus is ever built as a string; the index keeps its own. An index of up to lookup.SENT grams goes to every
worker, and nothing of the corpus is shuffled; a larger one is joined. There, what a row is found to have is kept
under a hash of its id and text, so null ids and repeated ones don't mix rows up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions import text as T
from quern.operators import lookup as L
from quern.sources.writers import stored

N = 13


def grams_of(df: DataFrame, id_col: str, text: Column, n: int = N) -> DataFrame:
    """id_col and gram: the distinct n-grams of each row. Rows of fewer words, null texts included, have none."""
    return df.select(id_col, F.explode(T.ngram_set(T.words(text), n)).alias("gram"))


def benchmark_index(benchmarks: DataFrame, text: Column, order: Column, n: int = N) -> DataFrame:
    """gram, and the least order among the benchmarks that have it: its owner. Null and blank texts have none; a null order counts only where no other is."""
    return benchmarks.where(F.trim(text) != "").select(order.alias("owner"), F.explode(T.ngram_set(T.words(text), n)).alias("gram")).groupBy("gram").agg(F.min("owner").alias("owner"))


def added_by_benchmark(index: DataFrame) -> DataFrame:
    """Grams that each benchmark was the first to have."""
    return index.groupBy("owner").agg(F.count(F.lit(1)).alias("added"))


def _known(index: DataFrame, n: int) -> DataFrame:
    """h, g (hashes as in lookup.keys) and gram of an index: a gram has its words between blanks."""
    return index.select("gram", F.inline(L.keys(F.split("gram", " "), n)))


def _hits(df: DataFrame, index: DataFrame, keys: list[Column], text: Column, n: int, sent: int = L.SENT) -> DataFrame:
    """keys and gram of each place where a row has a gram of the index; repeats stay."""
    known = stored(_known(index.select("gram").distinct(), n), "index")
    grams = L.Grams(known, sent)
    own = grams.all(T.words(text), n) if grams.fits else L.keys(T.words(text), n)
    return df.select(*keys, F.inline(own)).join(known, ["h", "g"]).drop("h", "g")


def overlaps(df: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N) -> DataFrame:
    """id_col and gram of every distinct n-gram that the index has. Rows that repeat an id, or have none, count as one; null texts have no grams."""
    return _hits(df, index, [F.col(id_col)], text, n).select(id_col, "gram").distinct()


def contaminated_ids(df: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N) -> DataFrame:
    """Each id that has a gram of the index, once; null is one of them if a row without id has."""
    return _hits(df, index, [F.col(id_col)], text, n).select(id_col).distinct()


def overlap_listing(df: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N) -> DataFrame:
    """id_col, n_overlaps and the overlapping grams in order."""
    return overlaps(df, index, id_col, text, n).groupBy(id_col).agg(F.count(F.lit(1)).alias("n_overlaps"), F.array_join(F.array_sort(F.collect_list("gram")), "|").alias("grams"))


def with_hits(df: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N, among: Column | None = None, hit: str = "hit", sent: int = L.SENT) -> DataFrame:
    """df with hit: whether the row's own text has a gram of the index; only rows of among are searched.

    An index of up to sent grams is looked up row by row. For a larger one, found keys are written to the shared folder first, so the
    planner knows their size. Null ids, repeated ids and repeated rows keep each their own verdict; a null text has no grams.
    """
    grams = L.Grams(stored(_known(index.select("gram").distinct(), n).select("h", "g"), "index"), sent)
    if grams.fits:
        return df.withColumn(hit, grams.any(T.words(text if among is None else F.when(among, text)), n))
    key = F.xxhash64(F.col(id_col), text)
    found = _hits(df if among is None else df.where(among), index, [key.alias("__key")], text, n, sent).select("__key").distinct()
    found = stored(found, "hits").withColumn("__found", F.lit(True))
    return df.withColumn("__key", key).join(found, "__key", "left").withColumn(hit, F.col("__found").isNotNull()).drop("__key", "__found")


def with_status(df: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = N) -> DataFrame:
    """df with status: too_short, too_long, contaminated or clean. Texts of a wrong length aren't searched.

    Every row stays and has its own status, whatever its id; a null text is too short. A column of df named status is replaced.
    """
    size = T.length_status(text)
    marked = with_hits(df.drop("status"), index, id_col, text, n, size == "ok", "__hit")
    return marked.withColumn("status", F.when(size != "ok", size).when(F.col("__hit"), "contaminated").otherwise("clean")).drop("__hit")


def status_counts(marked: DataFrame, by: str, words: Column) -> DataFrame:
    """Counts by status, clean words, and the share of contaminated ones among those of a fit length."""
    one = lambda s: F.sum((F.col("status") == s).cast("long"))
    out = marked.groupBy(by).agg(F.count(F.lit(1)).alias("streamed"), one("too_short").alias("too_short"), one("too_long").alias("too_long"), one("contaminated").alias("contaminated"), one("clean").alias("clean"), F.sum(F.when(F.col("status") == "clean", words).otherwise(0)).alias("clean_words"))
    return out.withColumn("contamination_rate", F.col("contaminated") / F.greatest(F.lit(1), F.col("streamed") - F.col("too_short") - F.col("too_long")))


def scan_corpus(df: DataFrame, queries: DataFrame, id_col: str, text: Column, query_id: str, query_text: Column, n: int = N, most: int = 10) -> DataFrame:
    """For each query the first documents, by id, that share an n-gram with it, up to most: query_id, id_col, n_overlaps, first_gram and context.

    Rows that repeat an id are one document, whose context is of the least of their texts that has first_gram's
    first word; null ids come first. Queries of fewer than n words find nothing.
    """
    asked = queries.select(F.col(query_id), F.explode(T.ngram_set(T.words(query_text), n)).alias("gram")).select(query_id, "gram")
    hit = _hits(df, asked, [F.col(id_col)], text, n).join(asked, "gram").select(query_id, id_col, "gram").distinct().groupBy(query_id, id_col).agg(F.count(F.lit(1)).alias("n_overlaps"), F.min("gram").alias("first_gram"))
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(id_col))
    top = stored(hit.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank"), "scan")
    texts = df.select(F.col(id_col).alias("__id"), text.alias("__text"))
    found = top.join(texts, F.col(id_col).eqNullSafe(F.col("__id"))).withColumn("context", T.snippet(F.col("__text"), F.split("first_gram", " ")[0]))
    return found.groupBy(query_id, id_col, "n_overlaps", "first_gram").agg(F.min_by("context", F.struct(~F.contains(F.lower("__text"), F.col("first_gram")), F.col("__text"))).alias("context"))


def grams_among(df: DataFrame, text: Column, wanted: DataFrame, n: int = N) -> DataFrame:
    """The n-grams of df that are among wanted (column gram), with repeats: what task_overlap needs of a corpus."""
    return _hits(df, wanted, [], text, n)


def task_overlap(tasks: DataFrame, train_grams: DataFrame, task_col: str, id_col: str, text: Column, n: int = N) -> DataFrame:
    """The inverse: documents of tasks any of whose grams occurs in the training grams (column gram, repeats allowed). A null id is in no list."""
    rows = tasks.select(task_col, id_col, F.explode(T.ngram_set(T.words(text), n)).alias("gram"))
    return rows.join(train_grams.select("gram").distinct(), "gram", "left_semi").groupBy(task_col).agg(F.array_sort(F.collect_set(id_col)).alias("doc_ids"))
