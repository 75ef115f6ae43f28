"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another (``low_quality``, then ``toxic``);
each model sees the text's features and the log odds of the categories before
it. While training, those log odds are out-of-fold predictions, so a later
model never sees an earlier one's fit to its own rows.

Features: presence of the words (64-bit hashes, whole text) whose association
with the category in the training rows is significant, strongest first, and a
few densities of the raw bytes. Training uses at most ``TRAIN_ROWS`` labelled
documents chosen by a hash of doc_id (the documented bound); prediction covers
all documents. Each category's threshold is the one of best F1 on out-of-fold
predictions.

Defined results: a null text, or one without words, has probability 0 in every
category and is not toxic. Labels repeated for one doc_id count as their
maximum; labels without a document do not train, and a null label does not train
its category (later ones see the fitted model's log odds for such a row). If the
sample has one class only, that category's probability is its base rate; a
category that no row is labelled for is found nowhere. Rows
repeated under one id get equal predictions. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.shingles import text_bytes, word_hashes
from toolgraph.llm.wordsplit import slices

CATEGORIES = ("low_quality", "toxic")
TRAIN_ROWS = 6000
FOLDS = 5
MAX_WORDS = 512
MIN_ROWS = 3
#: signed root of chi-square from which a word counts as associated
MIN_Z = 4.5
PENALTY = 1.0
ROWS_AT_ONCE = 256
_kind = np.zeros(256, np.uint8)  # 1 symbol, 2 digit, 3 upper case, 4 space
for _b in range(128):
    _c = chr(_b)
    _kind[_b] = 4 if _c.isspace() else 2 if _c.isdigit() else 3 if _c.isupper() else 0 if _c.isalpha() else 1


def features(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct word hashes of each text, and its dense features: log words, distinct share, symbol, digit, capital and space densities."""
    raw, offsets = text_bytes(texts)
    words, starts = word_hashes(texts)
    own = [np.unique(words[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    n = np.diff(starts)
    kinds = _kind[raw]
    sums = [np.concatenate([[0], np.cumsum(kinds == k)]) for k in (1, 2, 3, 4)]
    size = np.maximum(np.diff(offsets), 1)
    dense = np.stack([np.log1p(n) / 10, np.array([len(w) for w in own]) / np.maximum(n, 1), *[(s[offsets[1:]] - s[offsets[:-1]]) / size for s in sums]], axis=1)
    return own, dense


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def presence(rows: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(vocabulary)))
    if not len(vocabulary):
        return out
    lengths = np.array([len(r) for r in rows], np.int64)
    words = np.concatenate([np.zeros(0, np.uint64), *rows])
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    hit = vocabulary[at] == words
    out[np.repeat(np.arange(len(rows)), lengths)[hit], at[hit]] = 1.0
    return out


def associated_words(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Hashes of the words most associated with the label, sorted."""
    lengths = np.array([len(r) for r in rows], np.int64)
    words, inverse = np.unique(np.concatenate([np.zeros(0, np.uint64), *rows]), return_inverse=True)
    having = np.bincount(inverse, minlength=len(words)).astype(float)
    positive = np.bincount(inverse, weights=np.repeat(y, lengths), minlength=len(words))
    share = y.mean()
    z = (positive - having * share) / np.sqrt(np.maximum(having * share * (1 - share) * (1 - having / len(y)), 1e-9))
    good = np.flatnonzero((having >= MIN_ROWS) & (np.abs(z) >= MIN_Z))
    best = good[np.argsort(-np.abs(z[good]), kind="stable")[:MAX_WORDS]]
    return np.sort(words[best])


class Linear:
    """Logistic regression with a quadratic penalty on everything but the intercept, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        a = np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale])
        w = np.zeros(a.shape[1])
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        w[0] = np.log(share / (1 - share))
        penalty = np.full(len(w), PENALTY)
        penalty[0] = 0.0
        if 0 < y.sum() < len(y):
            for _ in range(25):
                p = sigmoid(a @ w)
                step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty + 1e-9), a.T @ (p - y) + penalty * w)
                w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
                if np.abs(step).max() < 1e-6:
                    break
        self.w = w

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.w[0] + ((x - self.mean) / self.scale) @ self.w[1:]


class Chain:
    """Models of all categories in order. ``labels``: 0, 1, or NaN where a row has none."""

    def __init__(self, rows: list[np.ndarray], dense: np.ndarray, labels: np.ndarray, names: tuple[str, ...] = CATEGORIES):
        self.names = names
        self.vocabularies: list[np.ndarray] = []
        self.models: list[Linear] = []
        self.thresholds: list[float] = []
        fold = np.arange(len(rows)) % FOLDS
        earlier = np.zeros((len(rows), 0))
        for k in range(len(names)):
            given = np.flatnonzero(~np.isnan(labels[:, k]))
            y = labels[given, k].astype(float) if len(given) else np.zeros(len(rows))
            given = given if len(given) else np.arange(len(rows))
            of = lambda places, words: np.hstack([presence([rows[i] for i in places], words), dense[places], earlier[places]])  # noqa: E731, B023
            words = associated_words([rows[i] for i in given], y)
            model = Linear(of(given, words), y)
            apart = model.log_odds(of(np.arange(len(rows)), words))
            for f in range(FOLDS) if len(given) >= 2 * FOLDS else []:
                own, out = np.flatnonzero(fold[given] != f), given[fold[given] == f]
                seen = associated_words([rows[i] for i in given[own]], y[own])
                apart[out] = Linear(of(given[own], seen), y[own]).log_odds(of(out, seen))
            self.vocabularies.append(words)
            self.models.append(model)
            self.thresholds.append(best_threshold(sigmoid(apart[given]), y))
            earlier = np.hstack([earlier, np.clip(apart, -30, 30)[:, None]])

    def probabilities(self, rows: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        earlier = np.zeros((len(rows), 0))
        for words, model in zip(self.vocabularies, self.models, strict=True):
            z = np.clip(model.log_odds(np.hstack([presence(rows, words), dense, earlier])), -30, 30)
            earlier = np.hstack([earlier, z[:, None]])
        return sigmoid(earlier) * np.array([len(r) > 0 for r in rows])[:, None]


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap below the last accepted row at the best F1; 0.5 without positives."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    ranked = np.concatenate([p[order], [0.0]])
    caught = np.cumsum(y[order])
    f1 = 2 * caught / (np.arange(1, len(y) + 1) + y.sum())
    f1[ranked[:-1] == ranked[1:]] = -1
    k = int(np.argmax(f1))
    return float((ranked[k] + ranked[k + 1]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, low_quality, toxic) of about ``limit`` labelled documents at most."""
    marked = (
        labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy("doc_id")
        .agg(F.max(1 - F.col("quality")).cast("int").alias("low_quality"), F.max("toxic").cast("int").alias("toxic"))
    )
    chance = marked.agg(F.least(F.lit(1.0), F.lit(limit) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("chance"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    chosen = marked.withColumn("draw", draw).join(F.broadcast(chance), F.col("draw") < F.col("chance")).select("doc_id", *CATEGORIES)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")  # at most limit rows


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Chain | None:
    """The chain fitted on the bounded sample; None without labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            words, dense = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([d.tobytes() for d in dense], pa.binary()), batch.column(2), batch.column(3)],
                ["doc_id", "words", "dense", *CATEGORIES],
            )

    rows = training_rows(docs, labels, limit)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "text", *CATEGORIES).mapInArrow(run, f"doc_id {kind}, words binary, dense binary, low_quality int, toxic int").toPandas()
    found = found[found["words"].map(len) > 0].sort_values(["doc_id", "words"])  # the same folds in every run
    if not len(found):
        return None
    words = [np.frombuffer(w, np.uint64) for w in found["words"]]
    return Chain(words, np.stack([np.frombuffer(d, np.float64) for d in found["dense"]]), found[list(CATEGORIES)].to_numpy(float))


def predict(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """(doc_id, p_<category> ..., <category> ...) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(f"p_{c}", T.DoubleType()) for c in CATEGORIES], *[T.StructField(c, T.BooleanType()) for c in CATEGORIES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        limits = np.array(model.thresholds if model else [1.0] * len(CATEGORIES))
        for batch in slices(batches, ROWS_AT_ONCE):
            p = model.probabilities(*features(batch.column(1))) if model else np.zeros((batch.num_rows, len(CATEGORIES)))
            over = (p >= limits) & (p > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, k], pa.float64()) for k in range(len(CATEGORIES))], *[pa.array(over[:, k], pa.bool_()) for k in range(len(CATEGORIES))]], schema.names
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return predict(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
