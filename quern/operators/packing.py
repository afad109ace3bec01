"""Fixed-length chunks of token ids: within documents, or across them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import lookup as L
from quern.operators.ordered import prefix_sum
from quern.sources.writers import stored

#: Words of a vocabulary that are sent to every worker (12 bytes a word); those beyond are joined.
SENT = L.SENT


def word_vocabulary(df: DataFrame, text: Column) -> DataFrame:
    """word, id, n: words by falling count, then by word, numbered from 0. Null texts have no words.

    The counts are sorted in parallel and numbered part by part, from how many words the parts before have.
    """
    counts = df.select(F.explode(T.words(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(counts.orderBy(F.col("n").desc(), "word").withColumn("__at", F.monotonically_increasing_id()), "vocabulary")
    part = F.shiftright("__at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row for each part
    before, starts = 0, []
    for r in sizes:
        starts += [F.lit(r["part"]), F.lit(before)]
        before += r["n"]
    start = F.create_map(*starts)[part] if starts else F.lit(0)
    return rows.select("word", (start + F.col("__at").bitwiseAND((1 << 33) - 1)).cast("int").alias("id"), "n")


def _sorted(known: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashes in order and ids of known (h, id), or None if two words share a hash."""
    h, ids = L.arrays(known)
    order = np.argsort(h, kind="stable")
    h, ids = h[order], ids[order]
    return None if (h[1:] == h[:-1]).any() else (h, ids)


def _looked_up(column: pa.ListArray, h: np.ndarray, number: np.ndarray, at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of hashes: where each begins, the hashes, their ids (-1 for those that h lacks). Of at_once words, each different one is looked up once."""
    first = column.offsets.to_numpy()
    words = column.values.slice(first[0], first[-1] - first[0])
    out = np.full(len(words), -1, np.int32)
    for lo in range(0, len(words) if len(h) else 0, at_once):
        some = words.slice(lo, at_once).dictionary_encode()
        own = some.dictionary.to_numpy()
        at = np.minimum(np.searchsorted(h, own), len(h) - 1)
        out[lo : lo + at_once] = np.where(h[at] == own, number[at], np.int32(-1))[some.indices.to_numpy()]
    return first - first[0], words.to_numpy(), out


def _lists(first: np.ndarray, values: np.ndarray, keep: np.ndarray) -> pa.ListArray:
    """Lists that begin at first, of the values to keep."""
    if not keep.all():
        first, values = np.concatenate([[0], np.cumsum(keep)])[first].astype(np.int32), values[keep]
    return pa.ListArray.from_arrays(pa.array(first), pa.array(values))


def encode_words(df: DataFrame, id_col: str, text: Column, vocabulary: DataFrame, out: str = "ids", carry: tuple[str, ...] = (), sent: int = SENT) -> DataFrame:
    """id_col, carry and out: the ids of a row's words, in order; words that the vocabulary lacks are left out.

    Rows that have no such word, null texts among them, are left out. Every other row stays, with ids null or repeated. A
    vocabulary of up to sent words goes to the workers as sorted hashes, so no word is shuffled. Of a larger one, those with ids below sent
    go, its most frequent words, and only words beyond them are joined. The driver holds 12 bytes for each word that is sent, and no more.
    """
    keep = list(dict.fromkeys([id_col, *carry]))
    known = vocabulary.select(F.xxhash64("word").alias("h"), F.col("id").cast("int").alias("id"))
    all_sent = vocabulary.count() <= sent
    table = _sorted(known if all_sent else known.where(F.col("id") < sent))
    if table is None or not all_sent and known.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():  # two words share a hash
        return _joined_words(df, keep, id_col, text, vocabulary, out)
    shared = df.sparkSession.sparkContext.broadcast(table)
    look_up, lists = _looked_up, _lists
    hashes = L.word_hashes(T.words(text))
    if all_sent:

        def look(column: pa.Array) -> pa.Array:
            first, _, ids = look_up(column, *shared.value)
            return lists(first, ids, ids >= 0)

        return df.select(*keep, F.arrow_udf(look, "array<int>")(hashes).alias(out)).where(F.size(out) > 0)

    def split(column: pa.Array) -> pa.Array:
        first, words, ids = look_up(column, *shared.value)
        return pa.StructArray.from_arrays([lists(first, ids, np.ones(len(ids), bool)), lists(first, words, ids < 0)], ["ids", "rest"])

    def fill(ids: pa.Array, places: pa.Array, numbers: pa.Array) -> pa.Array:
        """The k-th unknown word of a row gets the number whose place is k."""
        first = ids.offsets.to_numpy()
        values = ids.values.to_numpy()[first[0] : first[-1]].copy()
        first = first - first[0]
        unknown = np.flatnonzero(values < 0)
        own = places.offsets.to_numpy()
        row = np.repeat(np.arange(len(ids)), np.diff(own))
        before = np.searchsorted(unknown, first[:-1])
        values[unknown[before[row] + places.values.to_numpy()[own[0] : own[-1]]]] = numbers.values.to_numpy()[own[0] : own[-1]]
        return lists(first, values, values >= 0)

    rows = stored(df.select(*keep, F.arrow_udf(split, "struct<ids:array<int>,rest:array<bigint>>")(hashes).alias("__x"), F.monotonically_increasing_id().alias("__row")), "words")
    rare = rows.select("__row", F.posexplode("__x.rest").alias("__pos", "h")).join(known.where(F.col("id") >= sent), "h")
    rare = rare.groupBy("__row").agg(F.collect_list(F.struct("__pos", "id")).alias("__rare"))
    part = lambda c, k: F.coalesce(F.transform(c, lambda x: x[k]), F.array().cast("array<int>"))
    found = F.arrow_udf(fill, "array<int>")(F.col("__x.ids"), part("__rare", "__pos"), part("__rare", "id"))
    return rows.join(rare, "__row", "left").select(*keep, found.alias(out)).where(F.size(out) > 0)


def _joined_words(df: DataFrame, keep: list[str], id_col: str, text: Column, vocabulary: DataFrame, out: str) -> DataFrame:
    """encode_words by a join of every word, for a vocabulary whose hashes don't tell its words apart."""
    words = stored(df.select(*keep, T.words(text).alias("__words"), F.monotonically_increasing_id().alias("__row")), "words").select(*keep, "__row", F.posexplode("__words").alias("__pos", "__word"))
    joined = words.join(vocabulary.select(F.col("word").alias("__word"), F.col("id").alias("__id")), "__word")
    return joined.groupBy("__row", *keep).agg(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__id"))), lambda x: x["__id"]).alias(out)).drop("__row")


def chunks(df: DataFrame, ids: str, length: int, carry: list[str]) -> DataFrame:
    """Full chunks of each document, the rest left out: carry, chunk (number in the document) and input_ids. Null ids have none."""
    n = F.floor(F.size(ids) / length).cast("int")
    pieces = F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(F.col(ids), i * length + 1, length))).otherwise(F.array().cast("array<array<int>>"))
    return df.select(*carry, F.posexplode(pieces).alias("chunk", "input_ids"))


def chunk_stats(df: DataFrame, ids: str, length: int) -> DataFrame:
    """Documents, tokens, chunks and tokens left out; null without documents, but for their number."""
    n = F.size(ids)
    return df.agg(F.count(F.lit(1)).alias("docs"), F.sum(n).alias("tokens"), F.sum(F.floor(n / length)).cast("long").alias("chunks"), F.sum(n % length).alias("discarded"))


def across_documents(df: DataFrame, id_col: str, ids: str, length: int) -> DataFrame:
    """All documents one after another, by id, in blocks: block and input_ids; the unfinished last block is dropped.

    Each document cuts itself where blocks end, given the tokens before it; a block gathers its pieces. Only lengths
    are ordered and summed, beside the row. Null ids come first; of rows that repeat an id, the one with lesser tokens.
    """
    rows = stored(df.select(id_col, ids).where(F.size(ids) > 0), "tokens")
    rows = prefix_sum(rows, id_col, F.size(ids), "__before", then=[ids])
    first, last = F.floor(F.col("__before") / length), F.floor((F.col("__before") + F.size(ids) - 1) / length)
    parts = rows.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.lit(0), F.col("block") * length - F.col("__before"))
    end = F.least(F.size(ids), (F.col("block") + 1) * length - F.col("__before"))
    parts = parts.select("block", F.col("__before").alias("b"), F.slice(ids, (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece"))
    whole = parts.where(F.size("piece") == length).select("block", F.col("piece").alias("input_ids"))  # from one document: nothing to gather
    split = parts.where(F.size("piece") < length).groupBy("block").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("b", "piece"))), lambda x: x["piece"])).alias("input_ids"))
    return whole.unionByName(split.where(F.size("input_ids") == length))


def whole_shards(blocks: DataFrame, per_shard: int) -> DataFrame:
    """Blocks of full shards only."""
    total = blocks.agg(F.count(F.lit(1)).alias("__n"))
    return blocks.crossJoin(F.broadcast(total)).where(F.col("block") < F.floor(F.col("__n") / per_shard) * per_shard).drop("__n")


def chunk_quota(chunked: DataFrame, order: str, quota: int) -> DataFrame:
    """The first chunks by (order, chunk), quota of them."""
    return prefix_sum(chunked, order, F.lit(1), "ordinal", then=["chunk"]).where(F.col("ordinal") < quota)


def split_tokens(total: int, ratio: float, chunk: int) -> tuple[int, int]:
    """Chunks of the first and of the second language for a token total."""
    first = int(total * ratio)
    return first // chunk, (total - first) // chunk


def mixture(chunked: DataFrame, order: str, lang: str, quotas: dict[str, int]) -> DataFrame:
    """The first chunks of each language by (order, chunk), up to its quota, with part, the language's place in quotas: parts are read one after another.

    One language, a pair, three or all of them: quotas says. Languages without a quota go, one that has fewer chunks isn't filled up.
    """
    names = list(quotas)
    quota = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col(lang)]
    rows = prefix_sum(chunked.where(F.col(lang).isin(names)), order, F.lit(1), "ordinal", group=lang, then=["chunk"])
    return rows.where(F.col("ordinal") < quota).withColumn("part", F.array_position(F.array(*map(F.lit, names)), F.col(lang)) - 1)
