"""The corpus pipeline over a stream of files: normalise, judge, number, stop at the word budget.

The order-dependent parts (dense ids, the budget) need the state of all batches before. Each
micro-batch reads the state that its predecessor committed, writes its rows to a directory of its
own and commits its state last. A batch that is run again after a failure overwrites what it wrote, so
nothing is counted twice. There is no event time, hence no watermark; no state grows with the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import decontamination as D
from quern.operators.ordered import dense_ids, word_budget
from quern.sources.writers import stored

SCHEMA = "doc_id BIGINT, text STRING, lang STRING"
_STATE = "batch BIGINT, next_id BIGINT, words BIGINT"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def committed(spark: SparkSession, out: str, before: int | None = None) -> tuple[int, int]:
    """Next dense id and clean words so far, after all batches or those before one."""
    if not _exists(spark, f"{out}/state"):
        return 0, 0
    rows = spark.read.schema(_STATE).json(f"{out}/state/*")
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    last = rows.orderBy(F.col("batch").desc()).limit(1).collect()
    return (last[0]["next_id"], last[0]["words"]) if last else (0, 0)


def take_batch(batch: DataFrame, batch_id: int, index: DataFrame, out: str, target_words: int) -> None:
    """Write the clean documents of one micro-batch, numbered on from the state, and commit the new state."""
    spark = batch.sparkSession
    next_id, words = committed(spark, out, batch_id)
    path = f"{out}/clean/batch={batch_id}"
    rows = D.with_status(batch.withColumn("text", T.normalize(F.col("text"))), index, "doc_id", F.col("text")).where("status = 'clean'")
    rows = rows.select("doc_id", "lang", "text", T.word_count(F.col("text")).cast("long").alias("words"))
    if words < target_words:
        rows = stored(rows, "batch")  # it is read several times below
        kept = dense_ids(stored(word_budget(rows, "doc_id", F.col("words"), target_words - words), "budget"), "doc_id", "n")
        kept.select((F.col("n") + next_id).alias("dense_id"), "doc_id", "lang", "text", "words", (F.col("words_before") + words).alias("words_before")).write.mode("overwrite").parquet(path)
        n, more = spark.read.parquet(path).agg(F.count(F.lit(1)), F.coalesce(F.sum("words"), F.lit(0))).first()
        next_id, words = next_id + n, words + more
    state = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(next_id).cast("long").alias("next_id"), F.lit(words).cast("long").alias("words"))
    state.coalesce(1).write.mode("overwrite").json(f"{out}/state/{batch_id}")


def ingest(spark: SparkSession, source: str, index: DataFrame, out: str, target_words: int, schema: str = SCHEMA, files: int | None = None) -> DataFrame:
    """Run all that source (a directory of Parquet files, or one file) has now, files of them at once, and return all clean documents so far.

    Called again, it goes on after what it did, also after a crash: progress is kept under out/checkpoint.
    """
    stream = spark.readStream.schema(schema)
    if files:
        stream = stream.option("maxFilesPerTrigger", files)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        stream, source = stream.option("pathGlobFilter", at.getName()), at.getParent().toString()
    query = stream.parquet(source).writeStream.foreachBatch(lambda b, i: take_batch(b, i, index, out, target_words)).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    found = "dense_id BIGINT, doc_id BIGINT, lang STRING, text STRING, words BIGINT, words_before BIGINT, batch BIGINT"
    return spark.read.schema(found).parquet(f"{out}/clean") if _exists(spark, f"{out}/clean") else spark.createDataFrame([], found)
