"""Language identification with string kernels.

Two texts are as similar as the byte n-grams (blended spectrum, 1 to 3 bytes) that both
have, present or not: K(x, z) = |P(x) & P(z)| / sqrt(|P(x)| |P(z)|), with P limited to the
n-grams that some landmark text has. Landmarks, a few texts of each language, give a Nystrom
map phi(x) = K(x, landmarks) K(landmarks, landmarks)^(-1/2); on it, kernel ridge regression is
fitted for each language against the rest. A batch of texts is scored by two matrix products.

Fitting uses a bounded sample of labelled rows, drawn by a hash of the id; its bound
(sample) is a parameter. Scoring is one scan without a shuffle; the model, whose size depends on
the landmarks alone, goes out with the task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.llm import kernels as K
from quern.llm import store

#: Labelled texts of each language, at most, and the least and greatest length in characters that is looked for first.
SAMPLE, SHORTEST, LONGEST = 240, 200, 20_000
#: Landmarks of each language; ridge.
LANDMARKS, RIDGE = 32, 1e-2
#: A text is rejected if another language's score exceeds that of its label by more than this.
MARGIN = 0.5
#: Texts in one matrix product.
_ROWS = 64


def _codes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = buf.astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    return b, two, (two[:-1] << 8) | b[2:] if len(b) > 2 else np.zeros(0, np.int32)


class Places:
    """The column of an n-gram, or none, by two small tables: its bytes but the last give a row of the second."""

    def __init__(self, grams: np.ndarray, n: int, base: int, none: int) -> None:
        heads, which = np.unique(grams >> 8, return_inverse=True)
        self.row = np.full(1 << 8 * (n - 1), len(heads), np.int32)
        self.row[heads] = np.arange(len(heads))
        self.column = np.full((len(heads) + 1, 256), none, np.int32)
        self.column[which, grams & 255] = base + np.arange(len(grams))

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        return self.column[self.row[codes >> 8], codes & 255]


@dataclass
class Model:
    """languages; n-grams of each length, sorted; landmarks by n-gram, with rows of unit length; weights of phi for each language."""

    languages: list[str]
    grams: list[np.ndarray]
    landmarks: np.ndarray
    weights: np.ndarray

    def tables(self) -> list[Places]:
        """For each length, the column of an n-gram, or the column past the last."""
        out, base, none = [], 0, sum(map(len, self.grams))
        for n, g in enumerate(self.grams, 1):
            out.append(Places(g, n, base, none))
            base += len(g)
        return out

    def presence(self, buf: np.ndarray, off: np.ndarray, tables: list[Places]) -> np.ndarray:
        """Rows by n-grams: 1 where a text has it."""
        rows = len(off) - 1
        width = sum(map(len, self.grams))
        seen = np.zeros((rows, width + 1), np.uint8)
        row = np.repeat(np.arange(rows, dtype=np.int64) * (width + 1), np.diff(off))
        flat = seen.reshape(-1)
        for n, (codes, table) in enumerate(zip(_codes(buf), tables)):
            m = len(codes)
            if m <= 0:
                continue
            same = row[:m] == row[n : n + m]
            flat[(row[:m] + table[codes])[same]] = 1
        return seen[:, :width].astype(np.float32)

    def kernel(self, present: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return (present @ self.landmarks.T) / norm

    def scores(self, buf: np.ndarray, off: np.ndarray, tables: list[Places]) -> tuple[np.ndarray, np.ndarray]:
        """Scores by language, and how many known n-grams each text has."""
        present = self.presence(buf, off, tables)
        return self.kernel(present) @ self.weights, present.sum(axis=1)


def _batch(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def fit(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model of lower-cased texts and their languages; the first texts of each language are landmarks."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], [np.zeros(0, np.int64)] * 3, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    chosen = [i for lang in languages for i in [j for j, x in enumerate(labels) if x == lang][:landmarks]]
    grams: list[np.ndarray] = []
    per = [_codes(_batch([texts[i]])[0]) for i in chosen]
    for n in range(3):
        grams.append(np.unique(np.concatenate([p[n] for p in per])))
    model = Model(languages, grams, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    tables = model.tables()
    land = model.presence(*_batch([texts[i] for i in chosen]), tables)
    model.landmarks = land / np.sqrt(np.maximum(land.sum(axis=1, keepdims=True), 1))
    among = model.kernel(land).astype(np.float64)
    value, vector = np.linalg.eigh(among)
    value = np.maximum(value, 1e-6 * value.max())
    root = (vector / np.sqrt(value)) @ vector.T
    phi = np.concatenate([model.kernel(model.presence(*_batch(texts[i : i + _ROWS]), tables)) for i in range(0, len(texts), _ROWS)]).astype(np.float64) @ root
    target = np.where(np.array(labels)[:, None] == np.array(languages)[None], 1.0, -1.0)
    solved = np.linalg.solve(phi.T @ phi + ridge * len(texts) / len(languages) * np.eye(phi.shape[1]), phi.T @ target)
    model.weights = (root @ solved).astype(np.float32)
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE, shortest: int = SHORTEST, longest: int = LONGEST) -> Model:
    """Fit on at most sample rows of each label: those of the least hashes among texts of shortest to longest characters.

    A label that has no such text is learned from others of it, cut to longest characters; one that has only empty or null texts
    isn't learned, and identify then gives its documents no label_score. The sample costs a narrow count and one filtered scan: a hash threshold, from
    the counts, leaves about three times the rows that are wanted before any of them is ranked.
    """
    fits = F.length(text_col).between(shortest, longest)
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).alias("lang"), fits.alias("fits"), F.col(text_col).alias("t"), F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(7)), F.lit(1 << 40)).alias("h"))
    counts = {r["lang"]: (r["n"], bool(r["fits"])) for r in rows.groupBy("lang").agg(F.coalesce(F.sum(F.col("fits").cast("long")), F.lit(0)).alias("f"), F.count(F.lit(1)).alias("m")).select("lang", F.when(F.col("f") > 0, F.col("f")).otherwise(F.col("m")).alias("n"), (F.col("f") > 0).alias("fits")).collect()}
    if not counts:
        return fit([], [])
    share = F.create_map(*[F.lit(x) for lang, (n, _) in counts.items() for x in (lang, (1 << 40) if n <= 3 * sample else int((1 << 40) * 3 * sample / n))])[F.col("lang")]
    only = F.create_map(*[F.lit(x) for lang, (_, has) in counts.items() for x in (lang, has)])[F.col("lang")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))
    some = rows.where((F.col("h") <= share) & (F.col("fits") | ~only)).select("lang", "h", F.lower(F.substring("t", 1, longest)).alias("t"))
    got = some.withColumn("rank", rank).where(F.col("rank") <= sample).orderBy("lang", "rank").select("lang", "t").collect()
    return fit([r["t"] for r in got], [r["lang"] for r in got], landmarks, ridge)


def _judge(model: Model, tables: list[Places], text: pa.Array, label: pa.Array, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text: best language (-1 if none of its n-grams is known), its score, the score of the label (nan if unknown), and whether it is accepted."""
    n = len(text)
    best, score, own = np.full(n, -1, np.int64), np.zeros(n), np.full(n, np.nan)
    place = {lang: i for i, lang in enumerate(model.languages)}
    which = np.array([place.get(x, -1) for x in label.to_pylist()], np.int64)
    buf, off = K.utf8(text)
    for lo, hi in K.blocks(off):
        for a in range(lo, hi, _ROWS):
            b = min(hi, a + _ROWS)
            s, known = model.scores(buf[off[a] : off[b]], off[a : b + 1] - off[a], tables)
            if not s.shape[1]:
                continue
            top = s.argmax(axis=1)
            best[a:b] = np.where(known > 0, top, -1)
            score[a:b] = np.where(known > 0, s[np.arange(b - a), top], 0)
            has = np.flatnonzero((which[a:b] >= 0) & (known > 0))
            own[a + has] = s[has, which[a + has]]
    accepted = (best >= 0) & ~(score - own > margin)
    return best, score, own, accepted


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN) -> DataFrame:
    """One row for each row of docs: id_col, lang_col, language (the best score's), score, label_score and accepted.

    A text is accepted if it has an n-gram that a landmark has, and the best score exceeds that
    of its label by margin at most; where the label is null or none of the model's, the best
    language is taken for it. Null and empty texts have a null language and aren't accepted.
    Ties go to the language that comes first by name. Whole texts are read, lower-cased; repeated
    rows are judged each on its own; an empty table gives an empty one; other columns are
    ignored. label_score is null without a known label.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.lower(text_col).alias("t"))
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = pickle.loads(sent.value)
        tables = m.tables()
        names = np.array([*m.languages, None], object)
        for batch in batches:
            best, score, own, accepted = _judge(m, tables, batch.column(2), batch.column(1), margin)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names[best], pa.string()), pa.array(score, pa.float64()), pa.array(own, pa.float64(), mask=np.isnan(own)), pa.array(accepted)], ["id", "lang", "language", "score", "label_score", "accepted"])

    kind = src.schema["id"].dataType.simpleString()
    got = src.mapInArrow(K.tidy(run), f"id {kind}, lang string, language string, score double, label_score double, accepted boolean")
    return got.withColumnRenamed("lang", lang_col).withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN) -> DataFrame:
    """The rows of docs that identify accepts, with their columns; judged beside the row, in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    label = docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = pickle.loads(sent.value)
        tables = m.tables()
        for batch in batches:
            accepted = _judge(m, tables, batch.column(batch.num_columns - 1), batch.column(label), margin)[3]
            part = batch.filter(pa.array(accepted))
            yield pa.RecordBatch.from_arrays(part.columns[:-1], batch.schema.names[:-1])

    return docs.select("*", F.lower(text_col).alias(store.unused(docs.columns, "__lower"))).mapInArrow(K.tidy(run), docs.schema)
