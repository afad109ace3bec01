"""Order-dependent operators without a single-task window: prefix sums, dense ids, budgets, quotas.

A prefix sum over an order runs in three steps that all scale: bounds of about equal ranges of
the order key, a total for each range (and group), and a window within each range; the offset of
a range comes from the totals, which are as many as ranges times groups. The bounds are
literals, so retries and recomputation give the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def prefix_sum(df: DataFrame, order: str, value: Column, out: str, group: str | None = None, ranges: int | None = None, then: list[str] | None = None) -> DataFrame:
    """df with out: the sum of value over the rows before this one, by order (a number), then by the columns of then.

    With group, sums are taken within each of its values. A null value counts as 0; null keys come first.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(df.select(F.col(order).cast("double").alias("k")).approxQuantile("k", [i / n for i in range(1, n)], 0.25 / n))) if n > 1 else []
    place = F.lit(0)
    key = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    if bounds:
        edges = F.array(*map(F.lit, bounds))
        # The range that a key falls into, which is how many bounds it exceeds, by halving steps.
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
        most = F.lit(len(bounds))
        place = F.aggregate(steps, F.lit(0), lambda a, s: F.when((a + s <= most) & (key > F.element_at(edges, F.least(a + s, most))), a + s).otherwise(a))
    rows = df.withColumn("__v", F.coalesce(value.cast("long"), F.lit(0))).withColumn("__r", place)
    by = ["__r", *([group] if group else [])]
    totals = rows.groupBy(*by).agg(F.sum("__v").alias("__t"))
    over = Window.orderBy("__r") if not group else Window.partitionBy(group).orderBy("__r")
    offsets = totals.withColumn("__offset", F.coalesce(F.sum("__t").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__t")
    within = Window.partitionBy(*by).orderBy(order, *(then or [])).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__within", F.coalesce(F.sum("__v").over(within), F.lit(0)))
    matched = offsets.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], "__offset")
    cond = None
    for i, c in enumerate(by):
        one = rows[c].eqNullSafe(matched[f"__k{i}"])
        cond = one if cond is None else cond & one
    return rows.join(F.broadcast(matched) if len(bounds) < 10_000 and not group else matched, cond).withColumn(out, F.col("__offset") + F.col("__within")).drop("__v", "__r", "__within", "__offset", *[f"__k{i}" for i in range(len(by))])


def dense_ids(df: DataFrame, order: str, out: str = "dense_id", group: str | None = None, then: list[str] | None = None) -> DataFrame:
    """Row numbers from 0 by order, without gaps."""
    return prefix_sum(df, order, F.lit(1), out, group, then=then)


def word_budget(df: DataFrame, order: str, words: Column, target: int) -> DataFrame:
    """Rows until the words of those before reach target; the one that crosses it stays."""
    return prefix_sum(df, order, words, "words_before").where(F.col("words_before") < target)


def token_quota(df: DataFrame, order: str, tag: str, tokens: str, quotas: dict[str, int]) -> DataFrame:
    """For each tag, tokens (array) up to its quota: the crossing row is cut, later ones go. Tags without quota go.

    A null tag has no quota; null and empty arrays go; null orders come first. Rows that repeat an order come in any order.
    """
    quota = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col(tag)]
    rows = prefix_sum(df.withColumn("__q", quota).where("__q IS NOT NULL"), order, F.size(tokens), "__before", group=tag)
    keep = F.least(F.size(tokens), F.greatest(F.lit(0), F.col("__q") - F.col("__before"))).cast("int")
    return rows.withColumn("__keep", keep).where("__keep > 0").withColumn(tokens, F.slice(tokens, F.lit(1), F.col("__keep"))).drop("__q", "__before", "__keep")


def largest_remainder(counts: DataFrame, name: str, count: str, order: str, target: int) -> DataFrame:
    """Shares of target in proportion to counts, whole and of exact sum: the largest fractions get the rest, ties by order. Columns as before, and share."""
    total = counts.agg(F.sum(count).alias("__total"))
    w = Window.orderBy(F.col("__rem").desc(), F.col(order))
    rows = counts.crossJoin(total).withColumn("__product", F.col(count).cast("decimal(38,0)") * target).withColumn("__floor", F.expr(f"CAST(__product AS DECIMAL(38,0)) div CAST(__total AS DECIMAL(38,0))").cast("long")).withColumn("__rem", F.col("__product") - F.col("__floor").cast("decimal(20,0)") * F.col("__total"))
    rest = F.lit(target) - F.sum("__floor").over(Window.partitionBy())
    return rows.withColumn("__left", rest).withColumn("__rank", F.row_number().over(w)).withColumn("share", F.col("__floor") + (F.col("__rank") <= F.col("__left")).cast("long")).drop("__product", "__floor", "__rem", "__left", "__rank", "__total")


def prefix_lines(lines: DataFrame, file: str, order: str, line: str, targets: DataFrame) -> DataFrame:
    """The first words of each file, exactly as many as targets (file, share) says: whole lines as they are, the last one cut and joined by blanks."""
    n = F.size(F.regexp_extract_all(F.col(line), F.lit(r"\S+"), 0))
    rows = prefix_sum(lines, order, n, "__before", group=file).join(targets.select(file, "share"), file)
    left = F.col("share") - F.col("__before")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(line), F.lit(r"\S+"), 0), F.lit(1), left.cast("int")), " ")
    return rows.where(left > 0).withColumn("written", F.least(n, left.cast("int"))).withColumn(line, F.when(n >= left, cut).otherwise(F.col(line))).drop("__before", "share")


def skip_then_take(df: DataFrame, order: str, skip: int, take: int) -> DataFrame:
    """Rows skip to skip + take by order, numbered anew from 0 as held_id."""
    return dense_ids(df, order, "__i").where((F.col("__i") >= skip) & (F.col("__i") < skip + take)).withColumn("held_id", F.col("__i") - skip).drop("__i")


def interleave(df: DataFrame, order: str, group: str, rank: Column) -> DataFrame:
    """Round robin over groups: turn (from 0) and seat (rank of the group); sorted by them, a group that has run out is skipped.

    Null orders come first in their group, rows of one order in any order; a null group is a group. Columns turn and seat are replaced.
    """
    return dense_ids(df, order, "turn", group=group).withColumn("seat", rank)


def one_after_another(parts: list[DataFrame], order: str) -> DataFrame:
    """Union of parts with part, to be read in order of (part, order): the first is exhausted before the second begins.

    Every row stays; parts have the same columns, whatever their order; an empty part keeps its number.
    """
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("part", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out
