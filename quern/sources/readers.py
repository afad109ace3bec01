"""Readers: each gives a DataFrame with the columns that it promises, nulls made empty at the boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T


def documents(df: DataFrame, text: str = "text", url: str = "url") -> DataFrame:
    """text and url of raw web rows; what is missing is an empty string."""
    pick = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    rest = [c for c in df.columns if c not in (text, url)]
    return df.select(*rest, pick(text).alias("text"), pick(url).alias("url"))


def spread(df: DataFrame, least: int = 1 << 20) -> DataFrame:
    """df, which reads files, in as many parts as there are cores, where it has fewer and least bytes or more: a file of one row group is one task otherwise."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size >= least and df.rdd.getNumPartitions() < cores else df


def first_string_column(df: DataFrame) -> str:
    """The text column of a source that doesn't say: its first string column."""
    return next(n for n, t in df.dtypes if t == "string")


def shards(spark: SparkSession, path: str, columns: list[str], done: DataFrame | None = None) -> DataFrame:
    """Parquet shards but those whose name is in done (column shard), with their name: the directory shard=NAME if there is one, else the file's.

    Only columns are read. A null in done names nothing. Shards come in no order: sort by (shard, a key) where order matters.
    """
    df = spark.read.parquet(path)
    name = F.col("shard").cast("string") if "shard" in df.columns else F.element_at(F.split(F.input_file_name(), "/"), -1)
    out = df.select(*columns, name.alias("shard"))
    return out if done is None else out.join(done.select("shard").where("shard IS NOT NULL").distinct(), "shard", "left_anti").select(*columns, "shard")


def hive_partitions(spark: SparkSession, path: str, lang: str, columns: list[str]) -> DataFrame:
    """Rows below lang=LANG/topic=N of a Hive layout, with lang, topic and topic_order, the topic as text, by which topics are read: 0, 1, 10, 11, 2.

    Only that language's directories are listed and read. A language without a directory gives no rows.
    """
    rows = spark.read.parquet(path).where(F.col("lang") == lang)
    return rows.select(*columns, "lang", F.col("topic").cast("long").alias("topic"), F.col("topic").cast("string").alias("topic_order"))


def json_lines(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows of JSON lines; blank lines and those that don't parse are left out."""
    rows = lines.where(F.trim(value) != "").select(F.from_json(value, f"{schema}, _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return rows.where("r IS NOT NULL AND r._bad IS NULL").select("r.*").drop("_bad")


def annotation_lines(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Annotations with accepted: false for lines that don't parse or lack doc_id or annotation."""
    rows = lines.where(F.trim(value) != "").select(F.from_json(value, f"{schema}, _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return rows.select("r.*", (F.col("r._bad").isNull() & F.col("r.doc_id").isNotNull() & F.col("r.annotation").isNotNull()).alias("accepted")).drop("_bad")


def tsv(lines: DataFrame, columns: list[str], wanted: str, value: str = "value") -> DataFrame:
    """Distinct values of one column of tab-separated lines; missing ones are left out."""
    cell = F.get(F.split(value, "\t", -1), columns.index(wanted))
    return lines.select(cell.alias(wanted)).where(F.col(wanted) != "").distinct()


def benchmark_texts(df: DataFrame, columns: list[str], name: str, longer: int = 0) -> DataFrame:
    """bench and text: the columns of a benchmark, one below the other, blank and short values left out."""
    rows = df.select(F.lit(name).alias("bench"), F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("text"))
    return rows.where((F.trim("text") != "") & (F.length("text") > longer))


#: How benchmarks keep their texts.
MODES = ("default", "flores", "all_configs", "per_lang", "split_per_lang", "any_text")


def benchmark(tables: dict[str, DataFrame], mode: str, name: str, columns: list[str] = (), langs: list[str] = ()) -> DataFrame:
    """bench and text of a benchmark that is one or more tables (configs, by name), in one of MODES.

    default: columns of the first table; flores: a column for each of langs, named after it; all_configs: columns of every table;
    per_lang: of the tables of langs; split_per_lang: of the rows of the first table whose lang is among langs; any_text: every
    column in whose first rows is a longer text, or if there is none the second column, texts of more than five characters.
    Blank and null values are left out, a language or table that isn't there is skipped. bench is name, for several tables name and table.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    first = next(iter(tables.values()))
    if mode == "default":
        return benchmark_texts(first, columns, name)
    if mode == "flores":
        return benchmark_texts(first, [x for x in langs if x in first.columns], name)
    if mode == "split_per_lang":
        return benchmark_texts(first.where(F.col("lang").isin(list(langs))), columns, name)
    parts = []
    for table, df in tables.items():
        if mode == "per_lang" and table not in langs:
            continue
        found = text_columns(df) if mode == "any_text" else columns
        parts.append(benchmark_texts(df, found, f"{name}/{table}") if found else benchmark_texts(df, df.columns[1:2], f"{name}/{table}", longer=5))
    out = first.sparkSession.createDataFrame([], "bench string, text string")
    for p in parts:
        out = out.unionByName(p)
    return out


def text_columns(df: DataFrame, rows: int = 10, longer: int = 10) -> list[str]:
    """String columns that hold a text of more than some characters in the first rows."""
    strings = [n for n, t in df.dtypes if t == "string"]
    if not strings:
        return []
    seen = df.select(*strings).limit(rows).agg(*[F.max(F.length(c)).alias(c) for c in strings]).first()
    return [c for c in strings if (seen[c] or 0) > longer]


def whole_files(df: DataFrame, file: Column, order: str, text: str) -> DataFrame:
    """file and text: the rows of each file as one text, line by line."""
    return df.groupBy(file.alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n").alias("text"))


def lines_of(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """id_col, line_no (from 0) and line."""
    return df.select(id_col, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))


def gram_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """gram and document_id of lines that end in a blank and an id."""
    return lines.select(F.regexp_extract(value, r"(?s)^(.*) ([^ ]*)\z", 1).alias("gram"), F.regexp_extract(value, r"(?s)^(.*) ([^ ]*)\z", 2).alias("document_id"))


def nonblank(df: DataFrame, text: str) -> DataFrame:
    return df.where(T.strip(F.col(text)) != "")
