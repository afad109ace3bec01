import time

import pytest
from pyspark.sql import functions as F

from quern.llm import store


def test_sieve_misses_nothing(spark):
    ids = spark.range(0, 100_000, 7).toDF("id")
    has = store.sieve(ids)
    probes = spark.range(100_000).withColumn("in", has(F.col("id")))
    assert probes.where("id % 7 = 0 AND NOT `in`").count() == 0
    assert probes.where("id % 7 <> 0 AND `in`").count() < 0.02 * 86_000
    assert store.sieve(ids.limit(0)) is not None


def test_tables_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert store.new_path(spark, "x").startswith(shared)
    df = store.table(spark.range(3).toDF("a"), "t")
    assert df.count() == 3 and "ExistingRDD" not in df._jdf.queryExecution().toString()


def test_only_the_owners_tables_go(spark):
    mine = store.table(spark.range(3).toDF("a"), "mine")
    with store.owned("stage"):
        other = store.table(spark.range(4).toDF("a"), "other")
    store.drop_tables(spark, "stage")
    assert mine.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
        other.count()


def test_large_rows_go_alone(spark):
    store.small_batches(spark)
    sizes = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("t")).mapInArrow(lambda bs: (__import__("pyarrow").RecordBatch.from_arrays([__import__("pyarrow").array([b.num_rows])], ["n"]) for b in bs), "n long").collect()
    assert max(r["n"] for r in sizes) <= 9 and sum(r["n"] for r in sizes) == 40


def test_queries_equal_their_sql(spark):
    from quern.llm import registry
    from tests.oracle import database, difference

    con = database("/root/testdata/sf0.001")
    for name, sql in registry.oracle_sql().items():
        what = difference(registry.queries()[name](spark, "/root/testdata/sf0.001"), con, sql)
        assert not what or what.startswith("kinds only"), (name, what)


@pytest.mark.parametrize("name", ["op1_token_parquet", "op2_jpeg_thumbnails", "op5_best_fit_packing", "op6_bpe_encode_decode", "op8_html_content", "op10_language_id"])
def test_queries_run(spark, name):
    from quern.llm import registry

    got = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert got.count() > 0
    if name == "op5_best_fit_packing":  # every token of every document, by the library
        import tiktoken

        from quern.llm import bpe

        one = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={})
        parts = {}
        for r in got.collect():
            at = 0
            for i, start, n in zip(r["doc_ids"], r["starts"], r["lengths"]):
                parts.setdefault(i, []).append((start, r["tokens"][at : at + n]))
                at += n
        for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
            assert [t for _, p in sorted(parts.pop(r["doc_id"], [])) for t in p] == one.encode_ordinary(r["text"])
        assert not parts
    if name == "op6_bpe_encode_decode":
        assert got.where("NOT restored").count() == 0


def test_tables_leave_no_shuffle_files(spark):
    """What a table was made of goes from disk when it is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    files = lambda: {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())}
    there = files()
    kept = spark.range(10_000).repartition(4, "id")
    rows = store.table(kept, "brief")
    for _ in range(50):
        if not (left := {f for f in files() - there if f.startswith("shuffle_")}):
            break
        time.sleep(0.1)
    assert not left
    assert rows.count() == kept.count() == 10_000 and spark.conf.get(name) == before
