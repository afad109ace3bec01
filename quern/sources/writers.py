"""Sinks: shards with dense ids, manifests, Hive directories, JSON lines. All may be rerun: they overwrite what they write."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.ordered import dense_ids

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: spark.checkpoint.dir; where that is unset, a local session gets a temporary one."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="quern-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        there = f"file://{_own[app]}"
    return f"{there.rstrip('/')}/quern/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: what reads it more than once doesn't recompute it, and its size is known to the planner."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sharded(df: DataFrame, order: str, prefix: Column, per_shard: int = 50_000, id_col: str = "dense_id", pattern: str = "%s_clean_%05d.parquet") -> DataFrame:
    """df with dense ids by order, and shard, the name of the file that a row belongs to."""
    rows = dense_ids(df, order, id_col)
    return rows.withColumn("shard", F.format_string(pattern, prefix, F.floor(F.col(id_col) / per_shard)))


def manifest(rows: DataFrame, id_col: str = "dense_id") -> DataFrame:
    """First and last id of each shard."""
    return rows.groupBy("shard").agg(F.min(id_col).alias("first_doc_id"), F.max(id_col).alias("last_doc_id"))


def index_manifest(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"))


def write_shards(rows: DataFrame, path: str, partitions: list[str] = ("shard",)) -> None:
    """One directory for each shard; a shard that is written again replaces itself only."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_chunks(chunked: DataFrame, path: str, shard: str, per_file: int = 500_000) -> DataFrame:
    """Write chunks (columns of chunked) below path by shard, the name of the input shard they come from, but only shards that aren't there yet; all that path has.

    What was written before isn't read, let alone computed, again: a run that was stopped goes on with the shards that are
    missing. A shard is there once it is in the list below path/done, which is written after the chunks; until then a rerun overwrites it.
    """
    spark = chunked.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/done")
    rows = chunked
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        rows = rows.join(spark.read.schema(f"{shard} string").parquet(f"{path}/done"), shard, "left_anti")
    rows = rows.select(*chunked.columns)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", per_file).partitionBy(shard).parquet(f"{path}/chunks")
    found = spark.read.parquet(f"{path}/chunks").withColumn(shard, F.col(shard).cast("string"))
    found.select(shard).distinct().write.mode("overwrite").parquet(f"{path}/done-new")
    spark.read.parquet(f"{path}/done-new").write.mode("overwrite").parquet(f"{path}/done")
    return found.select(*chunked.columns)


def write_tiers(df: DataFrame, path: str, tier: str, kept: Column) -> DataFrame:
    """Three sinks of JSON lines below path: full (every row), final (kept rows) and tiers (kept rows by tier), and stats, a line for each tier; the stats.

    A null tier is written as Hive's default partition.
    """
    rows = stored(df.withColumn("__kept", F.coalesce(kept, F.lit(False))), "tiers")
    final = rows.where("__kept").drop("__kept")
    write_json(rows.drop("__kept"), f"{path}/full")
    write_json(final, f"{path}/final")
    write_json(final, f"{path}/tiers", [tier])
    stats = rows.groupBy(tier).agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("__kept").cast("long")).alias("kept"))
    stats.coalesce(1).write.mode("overwrite").json(f"{path}/stats")
    return stats


def write_hive(df: DataFrame, path: str, by: list[str] = ("lang", "topic"), per_file: int = 10_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).partitionBy(*by).parquet(path)


def write_json(df: DataFrame, path: str, by: list[str] = (), per_file: int = 10_000) -> None:
    w = df.write.mode("overwrite").option("maxRecordsPerFile", per_file)
    (w.partitionBy(*by) if by else w).json(path)


def truncated(df: DataFrame, order: str, rows: int) -> DataFrame:
    """The first rows by order, exactly so many if there are."""
    return dense_ids(df, order, "__i").where(F.col("__i") < rows).drop("__i")
