"""Stages of the corpus pipeline from a shell: python -m quern.cli [--config FILE]... [--set NAME=JSON]... STAGE...

A stage that has finished is skipped unless --again is given; each writes below its own folder of out, and leaves a
mark there when it is done, so a run that was stopped goes on.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import Settings, load
from quern.functions import heuristics as H
from quern.functions import text as T
from quern.operators import decontamination as D
from quern.operators import packing as P
from quern.operators import verify as V
from quern.operators.ordered import skip_then_take, word_budget
from quern.sources import readers as R
from quern.sources import writers as S

Stage = Callable[[SparkSession, Settings], None]


def _documents(spark: SparkSession, c: Settings) -> DataFrame:
    rows = R.spread(spark.read.parquet(c.documents))
    return rows.where(F.col("lang").isin(list(c.languages))) if c.languages else rows


def index(spark: SparkSession, c: Settings) -> None:
    """n-grams of the benchmark."""
    D.benchmark_index(spark.read.parquet(c.benchmark), F.col("text"), F.col("item_id"), c.gram).write.mode("overwrite").parquet(f"{c.out}/index/grams")


def decontaminate(spark: SparkSession, c: Settings) -> None:
    """Clean documents up to the word budget, in shards, with manifest and counts."""
    marked = D.with_status(_documents(spark, c).withColumn("text", T.normalize(F.col("text"))), spark.read.parquet(f"{c.out}/index/grams"), "doc_id", F.col("text"), c.gram)
    marked = S.stored(marked.withColumn("word_count", T.word_count(F.col("text"))), "marked")
    clean = S.stored(word_budget(marked.where("status = 'clean'"), "doc_id", F.col("word_count"), c.target_words).select("doc_id", "lang", "text", "word_count"), "clean")
    shards = S.sharded(clean, "doc_id", F.lit("all"), c.per_shard)
    S.write_shards(shards, f"{c.out}/decontaminate/shards")
    S.manifest(shards).write.mode("overwrite").json(f"{c.out}/decontaminate/manifest")
    D.status_counts(marked, "lang", F.col("word_count")).write.mode("overwrite").json(f"{c.out}/decontaminate/stats")


def filter_(spark: SparkSession, c: Settings) -> None:
    """Documents that pass the heuristic gate, by language."""
    rows = H.measured(spark.read.parquet(f"{c.out}/decontaminate/shards"), F.col("text"), F.col("lang")).where("passes").drop(*H.MEASURES)
    S.write_hive(rows, f"{c.out}/filter/rows", ["lang"])


def pretokenize(spark: SparkSession, c: Settings) -> None:
    """Chunks of word ids from the filtered documents, within the quotas if there are any."""
    rows = spark.read.parquet(f"{c.out}/filter/rows")
    words = S.stored(P.word_vocabulary(rows, F.col("text")), "words")
    words.write.mode("overwrite").parquet(f"{c.out}/pretokenize/vocabulary")
    chunked = P.chunks(P.encode_words(rows, "doc_id", F.col("text"), words, carry=("lang",)), "ids", c.chunk, ["doc_id", "lang"])
    if c.quotas:
        chunked = P.mixture(S.stored(chunked, "chunks"), "doc_id", "lang", c.quotas)
    chunked.write.mode("overwrite").parquet(f"{c.out}/pretokenize/chunks")


def verify(spark: SparkSession, c: Settings) -> None:
    """Lengths and ids of the chunks."""
    chunks, words = (spark.read.parquet(f"{c.out}/pretokenize/{x}") for x in ("chunks", "vocabulary"))
    V.wrong_lengths(chunks, "input_ids", c.chunk).crossJoin(V.outside_vocabulary(chunks, "input_ids", words.count())).coalesce(1).write.mode("overwrite").json(f"{c.out}/verify/report")


def hold_out(spark: SparkSession, c: Settings) -> None:
    """Documents after those that were skipped, in shards."""
    held = skip_then_take(_documents(spark, c).select("doc_id", "lang", "text"), "doc_id", c.held_out_skip, c.held_out_docs)
    S.write_shards(held.withColumn("shard", F.format_string("held_out_%05d", F.floor(F.col("held_id") / 10_000))), f"{c.out}/hold_out/shards")


STAGES: dict[str, Stage] = {"index": index, "decontaminate": decontaminate, "filter": filter_, "pretokenize": pretokenize, "verify": verify, "hold_out": hold_out}


def run(spark: SparkSession, settings: Settings, stages: list[str], again: bool = False) -> list[str]:
    """Run stages in their own order; those that ran. An unknown name is an error before anything runs."""
    if unknown := sorted(set(stages) - set(STAGES)):
        raise ValueError(f"no such stages: {', '.join(unknown)}")
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    ran = []
    for name, stage in STAGES.items():
        mark = fs_path(f"{settings.out}/{name}/_DONE")
        fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if name not in stages or fs.exists(mark) and not again:
            continue
        stage(spark, settings)
        fs.create(mark, True).close()
        ran.append(name)
    return ran


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--config", action="append", default=[], help="a file of settings; later ones overlay earlier ones")
    p.add_argument("--set", action="append", default=[], metavar="NAME=JSON", help="one setting")
    p.add_argument("--again", action="store_true", help="run stages that have finished, too")
    p.add_argument("stages", nargs="+", choices=[*STAGES, "all"])
    a = p.parse_args(args)
    settings = load(a.config, {k: json.loads(v) for k, _, v in (x.partition("=") for x in a.set)})
    spark = SparkSession.builder.appName("quern").getOrCreate()
    print(*run(spark, settings, list(STAGES) if "all" in a.stages else a.stages, a.again))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
