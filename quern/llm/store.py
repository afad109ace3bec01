"""Tables that cut lineage, in the folder that all executors share.

The folder is the session's spark.checkpoint.dir. Where that is unset, a local
session gets a temporary folder; a cluster gets an error, since a folder of one
machine is of no use to the others.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_made: dict[str, list[str]] = {}
_owner = ContextVar("owner", default="")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="quern-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Bound what passes between the JVM and Python at once, by rows and bytes, unless the session sets a bound itself.

    The defaults let a batch of texts or lists take hundreds of MB in either. A row beyond size goes alone. This changes
    the session's settings for all that it runs from then on; results are the same with any.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        if spark.sparkContext.getConf().get(f"spark.sql.execution.arrow.{name}") is None:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def unused(columns: list[str], name: str) -> str:
    """name, or a longer one that is none of columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/quern/{name}-{uuid.uuid4().hex}"
    _made.setdefault(_owner.get(), []).append(path)
    return path


@contextmanager
def owned(name: str) -> Iterator[None]:
    """Paths that new_path gives out inside are name's, and drop_tables(name) deletes no others."""
    token = _owner.set(name)
    try:
        yield
    finally:
        _owner.reset(token)


def fresh(spark: SparkSession, prefix: str) -> str:
    """A path beside prefix for a result that outlives drop_tables."""
    return f"{prefix}-{uuid.uuid4().hex}"


@contextmanager
def _brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it has ended, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: what follows doesn't recompute it."""
    path = new_path(df.sparkSession, name)
    with _brief_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, owner: str) -> None:
    """Delete what new_path gave out to owner so far. Only for a caller that has written every result made from it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = _made.get(owner, [])
    while made:
        path = jvm.org.apache.hadoop.fs.Path(made.pop())
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let the driver find out now which shuffles nothing refers to any more: their files go. Else they stay until it next collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bits of the largest sieve; beyond what that serves, joins go without one.
SIEVE_BITS = 1 << 29
_PROBES = 3
#: Words of a sieve (32 bits each) that are packed into one row.
_PACKED = 1 << 14


def sieve(ids: DataFrame) -> Callable[[Column], Column]:
    """A Bloom filter of the only column (bigint) of ids: true for each of them, and for a few others.

    It keeps rows that can't match from being shuffled into a join. It takes 12 to 24 bits for an id,
    made by a distributed aggregate and broadcast: 64 MB at most. For more ids than that serves,
    it is true of everything; the join that follows decides in any case.
    """
    (name,) = ids.columns
    n = ids.count()
    if 8 * n > SIEVE_BITS:
        return lambda c: F.lit(True)
    bits = min(SIEVE_BITS, max(1 << 10, 1 << (12 * n).bit_length()))
    at = F.explode(F.array(*[F.pmod(F.xxhash64(name, F.lit(i)), F.lit(bits)) for i in range(_PROBES)]))
    words = ids.select(at.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 32) AS int))")).alias("mask"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            word, mask = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint32)
            for b in np.unique(word // _PACKED):
                own = word // _PACKED == b
                found.setdefault(int(b), np.zeros(_PACKED, np.uint32))[word[own] % _PACKED] = mask[own]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([v.tobytes() for v in found.values()], pa.binary())], ["part", "bits"])

    # the driver gets the table's own bytes, no rows of words
    table = np.zeros(max(bits // 32, _PACKED), np.uint32)
    for r in words.repartition(F.floor(F.col("word") / _PACKED)).mapInArrow(packed, "part long, bits binary").toLocalIterator():
        table[r["part"] * _PACKED : (r["part"] + 1) * _PACKED] = np.frombuffer(r["bits"], np.uint32)
    sent = ids.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def has(*probes: pd.Series) -> pd.Series:
        hit = np.ones(len(probes[0]), bool)
        for p in probes:
            b = p.to_numpy(np.int64)
            hit &= (sent.value[b >> 5] >> (b & 31).astype(np.uint32)) & 1 == 1
        return pd.Series(hit)

    return lambda c: has(*[F.pmod(F.xxhash64(c.cast("long"), F.lit(i)), F.lit(bits)) for i in range(_PROBES)])
