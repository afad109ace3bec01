"""Documents to packed training sequences: language, repetition, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a
DataFrame that the caller writes as Parquet and reads again as the next one's docs.
"""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession

from quern.llm import bpe, jaccard, language, packing, passages, quality, store

#: SQL can't express string kernels or chains of seeds; tests compare stages with brute force.
ORACLE_SQL = None


_OWNER = "pipeline"


def _begun(spark: SparkSession) -> AbstractContextManager[None]:
    """What every stage begins with: bounds for batches; the tables of the stage before, whose result is written by now, go."""
    store.small_batches(spark)
    store.drop_tables(spark, _OWNER)
    return store.owned(_OWNER)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the classifier doesn't dispute.

    Null and empty texts go, and those without a known n-gram; a document whose label is null or unknown to the classifier stays. Rows are judged each on
    its own, so null and repeated ids do no harm; an empty table stays empty; further columns are kept, whatever their names.
    """
    with _begun(spark):
        return language.keep_accepted(docs, language.train(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that don't repeat themselves.

    Null, empty and wordless texts stay: nothing repeats in them. Rows are judged each on its own; further columns are kept, whatever their names.
    """
    with _begun(spark):
        return quality.keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact or near copies, the one of least id.

    Rows with a null id or without words stay; rows that repeat an id stay or go together. Further columns are kept, whatever their names.
    """
    with _begun(spark):
        return jaccard.keep_one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document, by id, has; a document of which nothing is left goes, n_chars is counted anew.

    Rows with a null id or text stay as they are; of rows that repeat an id, only those with the least text are cut. Further columns are kept, whatever their names.
    """
    with _begun(spark):
        return passages.cut_passages(docs)


def all_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """repeated_passages with every class of a seed joined to every other: edited passages of hot seeds aren't missed, at the square of these classes."""
    with _begun(spark):
        return passages.cut_passages(docs, lags=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens, and which part of which document comes where.

    Every token of every row is in one sequence; null and empty texts have none, ids may be null or repeat, further columns are left out.
    """
    with _begun(spark):
        return packing.sequences(bpe.with_tokens(docs.select("doc_id", "text"), kind="library", binary=True))


STAGES = [("language ID", language_id), ("quality rules", quality_rules), ("n-gram Jaccard join", near_copies), ("substring dedup", repeated_passages), ("best-fit packing", packed)]

#: The stages with the exact join of seeds.
EXACT_STAGES = [(name, all_repeated_passages if stage is repeated_passages else stage) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str, stages: list = STAGES) -> DataFrame:
    """All stages over documents (STAGES, or EXACT_STAGES); each one's result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = f"{store.shared_dir(spark)}/quern-pipeline-{spark.sparkContext.applicationId}"
    for i, (_, stage) in enumerate(stages):
        path = store.fresh(spark, f"{out}/{i}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
