from pyspark.sql import functions as F

from quern.operators import decontamination as D
from quern.streaming import ingest as I


def _rows(df):
    return sorted((r["dense_id"], r["doc_id"], r["words"], r["words_before"]) for r in df.collect())


def test_stream_equals_batch_and_survives_a_rerun(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    index = D.benchmark_index(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"), F.col("text"), F.col("item_id"))
    source = f"file://{tmp_path}/in"
    part = lambda lo, hi, mode: docs.where(F.col("doc_id").between(lo, hi)).coalesce(1).write.mode(mode).parquet(source)
    part(0, 79, "overwrite")
    once = I.ingest(spark, source, index, f"file://{tmp_path}/a", 30_000, files=1)
    first = _rows(once)
    assert [r[0] for r in first] == list(range(len(first)))
    assert _rows(I.ingest(spark, source, index, f"file://{tmp_path}/a", 30_000, files=1)) == first
    part(80, 199, "append")
    both = _rows(I.ingest(spark, source, index, f"file://{tmp_path}/a", 30_000, files=1))
    whole = _rows(I.ingest(spark, "/root/testdata/sf0.001/documents.parquet", index, f"file://{tmp_path}/b", 30_000))
    assert both == whole and both[: len(first)] == first
    assert I.committed(spark, f"file://{tmp_path}/a")[0] == len(both)
    # A batch that is run again, as after a crash before its commit, changes nothing.
    I.take_batch(docs.where("doc_id >= 80"), 1, index, f"file://{tmp_path}/a", 30_000)
    assert _rows(spark.read.parquet(f"file://{tmp_path}/a/clean")) == both
