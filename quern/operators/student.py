"""Student heads over embeddings, their metrics, and topic clusters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T

#: Fewer documents than this are no training set.
LEAST = 100


def embedding(c: Column, dims: int = 64, longest: int = 512, normalized: bool = True) -> Column:
    """A vector of a text's first characters: how often words fall into each of dims buckets by MD5, scaled to unit length.

    It stands in for a sentence encoder, which isn't part of this library. A null text, or one without words, is all zeros.
    """
    bucket = lambda x: F.conv(F.substring(F.md5(x), 1, 4), 16, 10).cast("int") % dims
    counts = T.let(F.transform(F.coalesce(T.words(F.substring(c, 1, longest)), F.array().cast("array<string>")), bucket), lambda b: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: F.size(F.filter(b, lambda x: x == k)).cast("double")))
    if not normalized:
        return counts
    return T.let(counts, lambda v: T.let(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(0.0))))


@dataclass
class Student:
    """A ridge head, logistic heads by name, and what scales their features, if anything."""

    ridge: Model
    heads: dict[str, Model]
    scaler: Model | None = None

    def features(self, df: DataFrame, vector: str) -> DataFrame:
        rows = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
        return rows if self.scaler is None else self.scaler.transform(rows.withColumnRenamed("features", "__raw")).drop("__raw")


def train_student(df: DataFrame, vector: str, score: str, classes: dict[str, str], alpha: float = 1.0, scaled: bool = False) -> Student:
    """Ridge regression of score, and a logistic regression for each of classes (name: label column); features brought to mean 0 and deviation 1 if scaled.

    Rows without a vector or a score aren't learned from; fewer than LEAST others are an error.
    """
    df = df.where(F.col(vector).isNotNull() & F.col(score).isNotNull())
    student = Student(None, {})
    if scaled:
        raw = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("__raw"))
        if raw.isEmpty():
            raise ValueError(f"0 documents are too few to learn from; {LEAST} are needed")
        student.scaler = StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True).fit(raw)
    rows = student.features(df, vector)
    n, spread = rows.agg(F.count(F.lit(1)), F.stddev_pop(score)).first()
    if n < LEAST:
        raise ValueError(f"{n} documents are too few to learn from; {LEAST} are needed")
    if scaled:  # its deviation divides by n - 1
        alpha = alpha * (n - 1) / n
    reg = alpha * (spread or 1.0) / n
    ridge = LinearRegression(featuresCol="features", labelCol=score, regParam=reg, elasticNetParam=0.0, standardization=False, solver="normal", predictionCol="quality").fit(rows.withColumn(score, F.col(score).cast("double")))
    heads = student.heads
    for name, label in classes.items():
        fit = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=100, predictionCol=name, rawPredictionCol=f"__raw_{name}", probabilityCol=f"__p_{name}")
        heads[name] = fit.fit(rows.withColumn(label, F.col(label).cast("double")))
    student.ridge = ridge
    return student


def clipped(score: Column, low: float = 0.0, high: float = 5.0) -> Column:
    return F.least(F.greatest(score, F.lit(low)), F.lit(high))


def score_documents(df: DataFrame, vector: str, student: Student) -> DataFrame:
    """df with quality, clipped, each head's class, and p_<head>, its probability of the last class."""
    out = student.ridge.transform(student.features(df, vector)).withColumn("quality", clipped(F.col("quality")))
    for name, head in student.heads.items():
        out = head.transform(out).withColumn(f"p_{name}", F.element_at(vector_to_array(f"__p_{name}"), -1)).drop(f"__raw_{name}", f"__p_{name}")
    return out.drop("features")


def metrics(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """n, mean absolute error, R squared and accuracy (of rounded predictions), from sums."""
    p, y = F.col(predicted), F.col(actual)
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(p - y)).alias("e"), F.sum((p - y) * (p - y)).alias("r"), F.sum(y).alias("y1"), F.sum(y * y).alias("y2"), F.sum((F.round(p) == y).cast("long")).alias("right"))
    spread = F.col("y2") - F.col("y1") * F.col("y1") / F.col("n")
    return sums.select("n", (F.col("e") / F.col("n")).alias("mae"), F.when(spread > 0, 1 - F.col("r") / spread).alias("r2"), (F.col("right") / F.col("n")).alias("accuracy"))


def fit_topics(df: DataFrame, vector: str, k: int = 200, rounds: int = 20, seed: int = 42) -> list[list[float]]:
    """Centroids of k-means with min(k, rows) clusters."""
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    n = df.count()
    if not n:
        return []
    model = KMeans(k=max(2, min(k, n)), maxIter=rounds, seed=seed).fit(rows) if n > 1 else None
    return [c.tolist() for c in model.clusterCenters()] if model else [list(df.first()[vector])]


def nearest_centroid(df: DataFrame, vector: str, centroids: list[list[float]], out: str = "topic") -> DataFrame:
    """df with the place of the centroid of least Euclidean distance; ties go to the first. Rows by centroids is one matrix product for each batch.

    Null without a vector, and everywhere if there are no centroids.
    """
    if not centroids:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    at = np.asarray(centroids, np.float64)
    norm = (at * at).sum(axis=1)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            there = s.notna().to_numpy()
            x = np.stack(s[there].to_numpy()).astype(np.float64) if there.any() else np.zeros((0, at.shape[1]))
            found = pd.Series(pd.NA, index=range(len(s)), dtype="Int64")
            found[there] = (norm - 2 * (x @ at.T)).argmin(axis=1).astype(np.int64)
            yield found

    return df.withColumn(out, F.pandas_udf(run, "bigint")(F.col(vector)))
