"""Encoding with the vocabulary of a finished tokenizer (JSON file), and looking into it."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_loaded: dict = {}


def _tokenizer(path: str):
    """This process's tokenizer; read once, as a worker serves many tasks."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
        _loaded[path].encode_special_tokens = True
    return _loaded[path]


def finished(folder: str, prefix: str, languages: list[str]) -> str:
    """The file of a finished tokenizer for a set of languages, whatever their order: folder/prefix-LANG-LANG.json.

    Tokenizers aren't trained here, so a set without one is an error that names what there is.
    """
    there = {}
    for name in sorted(os.listdir(folder)):
        if name.startswith(f"{prefix}-") and name.endswith(".json"):
            there.setdefault(tuple(sorted(name[len(prefix) + 1 : -5].split("-"))), os.path.join(folder, name))
    key = tuple(sorted(set(languages)))
    if key not in there:
        raise FileNotFoundError(f"no tokenizer for {'-'.join(key)} in {folder}; there are {', '.join('-'.join(k) for k in there) or 'none'}")
    return there[key]


def encode(df: DataFrame, text: str, path: str, out: str = "ids") -> DataFrame:
    """df with out: token ids without special tokens; a null text gives null."""
    rest = [c for c in df.columns if c != out]
    schema = df.select(*rest).schema.add(out, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for lo in range(0, len(texts), 64):
                some = texts.slice(lo, 64).to_pylist()
                found = tok.encode_batch_fast(["" if t is None else t for t in some], add_special_tokens=False)
                ids = pa.array([None if t is None else np.asarray(e.ids, np.int32) for t, e in zip(some, found)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, 64).columns[:-1], ids], [*batch.schema.names[:-1], out])

    return df.select(*rest, F.col(text).alias("__text")).mapInArrow(run, schema)


def decode(ids: str, path: str):
    """Expression: the text that ids stand for."""

    def run(s: pd.Series) -> pd.Series:
        tok = _tokenizer(path)
        return s.map(lambda x: None if x is None else tok.decode(list(map(int, x)), skip_special_tokens=False))

    return F.pandas_udf(run, "string")(F.col(ids))


def vocabulary(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """id and piece of ordinary tokens, the first ones by id if first says so. A vocabulary is small by nature."""
    tok = _tokenizer(path)
    special = {i for i, t in tok.get_added_tokens_decoder().items() if t.special}
    rows = sorted((i, p) for p, i in tok.get_vocab().items() if i not in special)
    return spark.createDataFrame(pd.DataFrame(rows[:first], columns=["id", "piece"]), "id BIGINT, piece STRING")


def inspect(words: DataFrame, first: int) -> DataFrame:
    """The first words of a word vocabulary, by id."""
    return words.where(F.col("id") < first).select("id", "word")
