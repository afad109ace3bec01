"""Token ids in Parquet list columns, laid out for selective reads.

Rows are sorted by id within each file, and pages are small, so the page index that
Parquet keeps for each column lets a reader skip all but a few pages of the ids, the metadata and
the token lists. Ids and counts are delta-encoded; token lists are dictionary-encoded
(indexes of as few bits as the vocabulary needs) or delta-encoded. Nothing is shuffled: files
follow the partitions of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group and of a page; rows of a page at most.
ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 64 << 10, 1000


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", tokens_col: str = "tokens", encoding: str = "dictionary", row_group: int = ROW_GROUP, page: int = PAGE, page_rows: int = PAGE_ROWS, mode: str = "error") -> None:
    """Write df as Parquet with tokens_col (array of int) in the encoding 'dictionary' or 'delta'.

    A column chunk whose dictionary wouldn't make it smaller, as where all ids differ, is delta-encoded by the writer.

    All columns of df are written; id_col and int or bigint columns are delta-encoded, strings
    dictionary-encoded. Null ids sort first; null lists and empty ones are kept apart; repeated
    rows are kept. An empty df gives a readable empty table.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    writer = (
        df.sortWithinPartitions(id_col)
        .write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", str(row_group))
        .option("parquet.page.size", str(page))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("parquet.dictionary.page.size", str(1 << 20))
        .option("parquet.page.write-checksum.enabled", "true")
    )
    for name, kind in df.dtypes:
        if kind in ("int", "bigint"):
            writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.option(f"parquet.enable.dictionary#{tokens_col}.list.element", str(encoding == "dictionary").lower()).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """The table at path, or only some columns and the rows that fulfil where: row groups and pages that can't hold such rows aren't read."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns is not None else df


def lengths(df: DataFrame, tokens_col: str = "tokens", count_col: str = "n_tokens") -> DataFrame:
    """df with count_col, the number of tokens (null for a null list), before tokens_col."""
    rest = [c for c in df.columns if c not in (tokens_col, count_col)]
    return df.select(*rest, F.when(F.col(tokens_col).isNotNull(), F.size(tokens_col)).alias(count_col), tokens_col)
