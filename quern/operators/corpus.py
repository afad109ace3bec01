"""Document-level operators: duplicates, held-out sets, samples, features, topic statistics, memorisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.functions import text as T
from quern.operators import lookup as L
from quern.sources.writers import stored


def first_of_each(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Of rows with one key, the first by order: one row for each key, null keys too.

    A null order comes last; of ties, the row with the least hash of all its columns stays, and of equal rows any one.
    Every task picks its first rows before anything is shuffled, so a hot key costs a row for each task.
    """
    over = Window.partitionBy("__key").orderBy(F.col(order).asc_nulls_last(), "__tie")
    rows = df.withColumn("__key", key).withColumn("__tie", F.xxhash64(*df.columns))
    return rows.withColumn("__rank", F.row_number().over(over)).where("__rank = 1").drop("__key", "__tie", "__rank")


def last_annotation(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key, the last by order."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(key, *[F.col(f"__row.{c}") for c in rest])


def unordered_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()


def held_out(full: DataFrame, train: DataFrame, text_col: str) -> DataFrame:
    """Rows of full whose stripped text isn't in train; blank ones go, repeats stay."""
    seen = train.select(T.stripped_hash(F.col(text_col)).alias("__h")).distinct()
    rows = full.where(T.strip(F.col(text_col)) != "").withColumn("__h", T.stripped_hash(F.col(text_col)))
    return rows.join(seen, "__h", "left_anti").drop("__h")


def hash_sample(df: DataFrame, id_col: str, group: str, per_group: int, seed: str = "42") -> DataFrame:
    """per_group rows of each group, those of the least MD5 of seed and id: uniform, without replacement, the same on every run."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.withColumn("__h", h).withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy("__h", id_col))).where(F.col("__rank") <= per_group).drop("__h", "__rank")


def tiered_top(df: DataFrame, tier: str, score: str, order: str, total: int, weights: dict[str, float]) -> DataFrame:
    """The best rows of each tier, int(total * weight) of them; a tier that has fewer isn't filled up from others.

    Ties go by order; null scores come last; a null tier, or one without a weight, has none.
    """
    quota = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, int(total * w))])[F.col(tier)]
    rank = F.row_number().over(Window.partitionBy(tier).orderBy(F.col(score).desc(), F.col(order)))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= F.coalesce(quota, F.lit(0))).drop("__rank")


def hash_split(df: DataFrame, id_col: str, share: float = 0.1, seed: str = "42") -> DataFrame:
    """df with is_val: true for about share of the rows, by a hash of the id."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 6), 16, 10).cast("long")
    return df.withColumn("is_val", bucket < int(share * (1 << 24)))


def first_then_long(df: DataFrame, order: str, text_col: str, first: int, longer: int = 200) -> DataFrame:
    """Of the first rows by order, those with a long text."""
    return df.orderBy(order).limit(first).where(F.length(text_col) > longer)


def gram_counts(df: DataFrame, text: Column, n: int = 5) -> DataFrame:
    """How often each n-gram occurs in the corpus, repeats within a document counted."""
    return df.select(F.explode(T.ngrams(T.words(text), n)).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def top_grams(counts: DataFrame, most: int = 500_000) -> DataFrame:
    """The most frequent grams, exactly most if there are, ties by gram.

    How many grams have each count says which counts are out, and of those that are left only as many as needed are
    taken, part by part of a parallel sort: no task reads the first rows of all others. The grams are shuffled once: both uses read the same exchange.
    """
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("__grams"))
    over = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a row for each count that occurs
    least = sizes.withColumn("__more", F.coalesce(F.sum("__grams").over(over), F.lit(0))).where(F.col("__more") < most).agg(F.min("n").alias("__least"))
    rows = counts.crossJoin(F.broadcast(least)).where("n >= __least").drop("__least")
    order = [F.col("n").desc(), F.col("gram")]
    return first_sorted(rows, order, most).orderBy(*order)


def first_sorted(df: DataFrame, order: list, most: int) -> DataFrame:
    """The first rows by order, which has no ties: sorted in parallel and written, then so many of each part as the parts before leave."""
    rows = stored(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    left, ends = most, []
    for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # a row for each part
        ends += [F.lit(r["part"]), F.lit(min(left, r["n"]))]
        left -= min(left, r["n"])
    end = F.create_map(*ends)[part] if ends else F.lit(0)
    return rows.where(F.col("__at").bitwiseAND((1 << 33) - 1) < end).drop("__at")


#: An n-gram's place: its hash and the document that has it.
_PLACE = np.dtype([("h", "<i8"), ("row", "<i8")])


def memorization(df: DataFrame, id_col: str, text: Column, n: int = 5, least: int = 3, parts: int | None = None) -> DataFrame:
    """For each document its n-grams, those that the corpus has least times or more, and their share (0 without n-grams).

    Rows that repeat an id count as one document, in a row for each of them; a null id has 0. Null texts have no n-grams.
    N-grams are told apart by 64-bit hashes; each is shuffled once, as 16 bytes that are packed by range of the hash, with the document it is in.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or 4 * tasks  # several in a task, one after another
    place = _PLACE

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_numpy()
            for row, counts, h, _ in L.rolled(b.column(1), n, check=False):
                found = np.zeros(len(h), place)
                found["h"], found["row"] = h, np.repeat(own[row : row + len(counts)], counts)
                to = (h.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                order = np.argsort(to, kind="stable")
                found, to = found[order], to[order]
                at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays([pa.array(to[at].astype(np.int32)), pa.array([x.tobytes() for x in np.split(found, at[1:])] if len(to) else [], pa.binary())], ["part", "places"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1)):
                by.setdefault(k, []).append(np.frombuffer(x.as_buffer(), place))
        while by:
            found = np.concatenate(by.popitem()[1])
            _, which, times = np.unique(found["h"], return_inverse=True, return_counts=True)
            own, hits = np.unique(found["row"][times[which] >= least], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(hits.astype(np.int64))], ["row", "k"])

    rows = df.select(F.xxhash64(id_col).alias("row"), L.word_hashes(T.words(text)).alias("w"))
    places = rows.mapInArrow(packed, "part INT, places BINARY").repartition(tasks, "part")
    hits = places.mapInArrow(repeated, "row BIGINT, k BIGINT").groupBy("row").agg(F.sum("k").alias("repeated"))
    sizes = F.greatest(F.size(T.words(text)) - (n - 1), F.lit(0)).cast("long")
    grams = df.select(id_col, sizes.alias("grams"))
    per = grams.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.sum("grams").alias("grams"))
    per = per.join(hits.withColumnRenamed("row", "__row"), F.xxhash64(id_col) == F.col("__row"), "left").drop("__row")
    return df.select(id_col).join(per, id_col, "left").select(id_col, F.coalesce("grams", F.lit(0)).alias("grams"), F.coalesce("repeated", F.lit(0)).alias("repeated")).withColumn("score", F.when(F.col("grams") > 0, F.col("repeated") / F.col("grams")).otherwise(0.0))


#: An annotator gives a reply for a prompt, or None; what it raises counts as None.
Annotator = Callable[[str], str | None]

#: Groups of flags that an annotation has.
ANNOTATION = "struct<readability:struct<elementary:boolean,middle:boolean,high:boolean>,comprehension:struct<easy:boolean,independent:boolean,low_difficulty:boolean>,vocabulary:struct<simple:boolean,complex:boolean,jargon:boolean,figurative:boolean>,pedagogy:struct<curriculum_relevant:boolean,level_appropriate:boolean,instructional:boolean>,engagement:struct<experiential:boolean,engaging:boolean,length_appropriate:boolean>,topic:struct<science:boolean,math:boolean,social_science:boolean,language:boolean>>"


def flag(c: Column, group: str, name: str) -> Column:
    """A flag of an annotation; missing groups and flags are false."""
    return F.coalesce(c[group][name], F.lit(False))


def quality_score(c: Column) -> Column:
    names = [("readability", "elementary"), ("comprehension", "easy"), ("pedagogy", "curriculum_relevant"), ("engagement", "engaging"), ("vocabulary", "simple")]
    return sum((flag(c, g, n).cast("int") for g, n in names[1:]), flag(c, *names[0]).cast("int"))


def difficulty(c: Column) -> Column:
    return F.when(flag(c, "readability", "high"), 3).when(flag(c, "readability", "middle"), 2).when(flag(c, "readability", "elementary"), 1).otherwise(2)


def topic_label(c: Column) -> Column:
    out = F.lit("other")
    for t in ("language", "social_science", "math", "science"):
        out = F.when(flag(c, "topic", t), t).otherwise(out)
    return out


def feature_rows(annotations: DataFrame, texts: DataFrame, id_col: str = "doc_id", annotation: str = "annotation") -> DataFrame:
    """Features of annotated documents, with their text or an empty one.

    Every annotation gives one row, also a repeated one; of texts that repeat an id, the least counts, and a null id has none.
    """
    c = F.col(annotation)
    rows = annotations.select(id_col, quality_score(c).alias("quality_score"), difficulty(c).alias("difficulty_level"), flag(c, "vocabulary", "complex").alias("vocab_complexity"), flag(c, "vocabulary", "jargon").alias("has_jargon"), flag(c, "engagement", "engaging").alias("engagement"), topic_label(c).alias("topic_label"))
    return rows.join(texts.groupBy(id_col).agg(F.min("text").alias("text")), id_col, "left").withColumn("text", F.coalesce("text", F.lit("")))


def distribution(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows for each value from low to high, 0 where there is none: value and n."""
    spine = df.sparkSession.range(low, high + 1).select(F.col("id").alias("value"))
    counts = df.groupBy(F.col(column).cast("long").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def rule_annotation(c: Column) -> Column:
    """An annotation by rules, where no model is at hand: the same for the same text."""
    return T.let(F.struct(F.length(c).alias("n"), T.word_count(c).alias("w"), F.lower(c).alias("low")), _rules)


def _rules(x: Column) -> Column:
    n, w = x["n"], x["w"]
    has = lambda word: F.contains(x["low"], F.lit(word))
    return F.struct(
        F.struct((n <= 5 * w).alias("elementary"), ((n > 5 * w) & (n <= 7 * w)).alias("middle"), (n > 8 * w).alias("high")).alias("readability"),
        F.struct((w < 300).alias("easy"), (w < 600).alias("independent"), (w < 100).alias("low_difficulty")).alias("comprehension"),
        F.struct((n <= 6 * w).alias("simple"), (n > 7 * w).alias("complex"), has("ingation").alias("jargon"), has("like").alias("figurative")).alias("vocabulary"),
        F.struct(has("the").alias("curriculum_relevant"), F.lit(True).alias("level_appropriate"), has("instruction").alias("instructional")).alias("pedagogy"),
        F.struct(F.lit(False).alias("experiential"), has("!").alias("engaging"), w.between(50, 1000).alias("length_appropriate")).alias("engagement"),
        F.struct(has("tion").alias("science"), has("eau").alias("math"), has("keit").alias("social_science"), has("ci").alias("language")).alias("topic"),
    )


def annotated(df: DataFrame, text: Column, annotator: Annotator, calibration: Column | None = None, tries: int = 2, at_once: int = 32, out: str = "annotation") -> DataFrame:
    """df with out: what the annotator replies to each text's prompt, as an annotation; null where it fails tries times.

    A failure is an exception, None, or a reply that isn't a JSON object with at least one group; a code fence around it is fine. In each
    task at_once prompts wait for replies at a time, so a slow service keeps its connections busy. A null text is asked about as an empty one. The
    annotator travels to the workers, so it must be picklable; it may be asked again where a task is run again.
    """

    def ask(question: str) -> str | None:
        for _ in range(tries):
            try:
                reply = annotator(question)
            except Exception:  # noqa: BLE001
                reply = None
            if reply is not None and "{" in reply:
                return reply
        return None

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with ThreadPoolExecutor(at_once) as pool:
            for s in batches:
                yield pd.Series(list(pool.map(ask, s)), dtype=object)

    reply = F.pandas_udf(run, "string")(prompt(text, calibration))
    found = df.withColumn("__reply", reply).withColumn(out, F.from_json(T.fenced_json(F.col("__reply")), ANNOTATION))
    groups = sum((F.col(out)[g].isNotNull().cast("int") for g in ("comprehension", "vocabulary", "pedagogy", "engagement", "topic")), F.col(out)["readability"].isNotNull().cast("int"))
    return found.withColumn(out, F.when(groups > 0, F.col(out))).drop("__reply")


PROMPT = "Judge the text for learners. Answer with one JSON object that has the groups readability, comprehension, vocabulary, pedagogy, engagement and topic, each with flags that are true or false.\n{calibration}\nText:\n{input_text}"


def prompt(c: Column, calibration: Column | None = None, longest: int = 2000) -> Column:
    """What an annotator is asked about a text: examples first, then the beginning of the text."""
    shown = F.substring(F.coalesce(c, F.lit("")), 1, longest)
    examples = F.lit("") if calibration is None else F.coalesce(calibration, F.lit(""))
    return F.replace(F.replace(F.lit(PROMPT), F.lit("{calibration}"), examples), F.lit("{input_text}"), shown)


def topic_stats(df: DataFrame, lang: str, topic: str, quality: str, level: str) -> DataFrame:
    """For each language and topic, null ones too: count, sum of quality, and documents of each difficulty. Null qualities and levels don't count in their sums."""
    one = lambda k: F.sum((F.col(level) == k).cast("long"))
    return df.groupBy(lang, topic).agg(F.count(F.lit(1)).alias("count"), F.sum(quality).alias("quality_sum"), one(1).alias("level_1"), one(2).alias("level_2"), one(3).alias("level_3")).withColumn("avg_quality", F.col("quality_sum") / F.col("count"))


def index_totals(stats: DataFrame, lang: str) -> DataFrame:
    """By language: topics, documents and mean quality, from what topic_stats counted."""
    out = stats.groupBy(lang).agg(F.count(F.lit(1)).alias("topics"), F.sum("count").alias("docs"), F.sum("quality_sum").alias("__q"))
    return out.select(lang, "topics", "docs", F.round(F.col("__q") / F.col("docs"), 3).alias("avg_quality"))


def corpus_totals(by_language: DataFrame) -> DataFrame:
    """One row over all languages, from index_totals."""
    return by_language.agg(F.count(F.lit(1)).alias("languages"), F.sum("docs").alias("docs"), F.sum("topics").alias("topics"))
