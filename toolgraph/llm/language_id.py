"""Language identification by interpolated Kneser-Ney character models.

Training: a bounded sample of documents a language (``SAMPLE_DOCS`` by hash of
id and text; whole texts) is cut into character n-grams, which Spark counts by
language and n-gram. From the counts one task a language builds a model of order
``ORDER``: continuation counts below the top order, one absolute discount an
order (from the numbers of n-grams seen once and twice), lower orders
interpolated, a uniform floor over the alphabet. A model is stored as sorted
arrays of 64-bit n-gram hashes with fully interpolated log probabilities and the
log back-off weight of each context; these arrays are all that reaches the
driver of it.

Prediction: text is lower-cased and everything but letters becomes one space.
The n-grams of a batch are looked up once each by binary search in each
language's arrays; a document's score is its cross-entropy a character, and the
lowest wins. A part of the sample that the counts did not see calibrates two
things: the temperature that turns cross-entropies into a probability
(``score``), and for each language the mean and the spread of cross-entropy by
length. A text whose cross-entropy lies ``REJECT_SD`` deviations above that is
rejected: it is written in none of the languages. Lang, source and doc_id of
the documents that are predicted are never used.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and is rejected. Rows without lang do not train. Every language with a letter in
its training documents is learned; one of fewer than ``MIN_DOCS`` sampled
documents, or with none or nothing else set apart, is calibrated on what it
trained on. With no training documents at all, everything is ``und``. Repeated rows get equal predictions. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.shingles import mix
from toolgraph.llm.wordsplit import slices
from toolgraph.scratch import materialize

ORDER = 4
#: training documents a language, at most (every fifth of them calibrates); bounds the model, which is broadcast
SAMPLE_DOCS = 1000
MIN_DOCS = 10
REJECT_SD = 8.0
#: nats a character by which documents of one language differ at least, however alike the calibration texts are
MIN_SD = 0.2
ROWS_AT_ONCE = 256
#: numpy work on a text's characters takes a hundred times its bytes
BYTES_AT_ONCE = 1 << 19
NOT_LETTERS = regex.compile(r"\P{L}+")
STEP = 0x9E3779B97F4A7C15


def letters_only(text: str | None) -> str:
    """Lower case, every run of other characters one space, a space at both ends; empty if there is no letter."""
    kept = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {kept} " if kept else ""


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each starts (one more entry)."""
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), starts


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each position (positions before n-1 are meaningless)."""
    h = np.zeros(len(points), np.uint64)
    for k in range(n - 1, -1, -1):
        shifted = points if k == 0 else np.concatenate([np.zeros(k, np.uint64), points[:-k]])[: len(points)]
        h = h * np.uint64(STEP) + shifted + np.uint64(1)
    return mix(h)


class KneserNey:
    """One language's model: for each order sorted hashes, log probabilities, and log back-off weights of contexts."""

    def __init__(self, grams: dict[str, int], order: int):
        """``grams``: counts of n-grams of the top order."""
        self.order = order
        counts: list[dict[str, int]] = [{} for _ in range(order + 1)]
        counts[order] = grams
        for n in range(order - 1, 0, -1):  # continuation counts: distinct characters to the left
            lower: dict[str, int] = {}
            for g in counts[n + 1]:
                lower[g[1:]] = lower.get(g[1:], 0) + 1
            counts[n] = lower
        alphabet = len(counts[1])
        self.floor = -np.log(alphabet + 1.0)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.backoffs: list[tuple[np.ndarray, np.ndarray]] = []
        below: dict[str, float] = {"": 1.0 / (alphabet + 1)}
        for n in range(1, order + 1):
            once = sum(c == 1 for c in counts[n].values())
            twice = sum(c == 2 for c in counts[n].values())
            discount = min(0.95, max(0.05, once / (once + 2.0 * twice) if once else 0.5))
            total: dict[str, int] = {}
            kinds: dict[str, int] = {}
            for g, c in counts[n].items():
                total[g[:-1]] = total.get(g[:-1], 0) + c
                kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
            weight = {c: discount * kinds[c] / total[c] for c in total}
            lowest = below.get("", 0.0)
            here = {g: (c - discount) / total[g[:-1]] + weight[g[:-1]] * (below[g[1:]] if n > 1 else lowest) for g, c in counts[n].items()}
            self.tables.append(self._sorted(here, n))
            self.backoffs.append(self._sorted(weight, n - 1))
            below = here

    def arrays(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [*self.tables, *self.backoffs]

    @classmethod
    def of_arrays(cls, arrays: list[tuple[np.ndarray, np.ndarray]], floor: float) -> KneserNey:
        model = cls.__new__(cls)
        model.order, model.floor = len(arrays) // 2, floor
        model.tables, model.backoffs = arrays[: model.order], arrays[model.order :]
        return model

    @staticmethod
    def _sorted(values: dict[str, float], n: int) -> tuple[np.ndarray, np.ndarray]:
        keys = list(values)
        if n == 0:
            return np.zeros(1, np.uint64), np.log(np.array([values[""]])).astype(np.float32)
        points = np.frombuffer("".join(keys).encode("utf-32-le"), "<u4").astype(np.uint64)
        hashes = gram_hashes(points, n)[n - 1 :: n]
        order = np.argsort(hashes)
        return hashes[order], np.log(np.array([values[k] for k in keys]))[order].astype(np.float32)

    def log_probabilities(self, hashes: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Of characters given up to order - 1 before them: ``hashes[n-1]`` ends at the character, ``contexts[n]`` (n characters) just before it."""
        out = np.zeros(len(hashes[0]), np.float32)
        left = np.arange(len(out))
        for n in range(self.order, 0, -1):
            keys, logs = self.tables[n - 1]
            wanted = hashes[n - 1][left]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            out[left[hit]] += logs[at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            keys, logs = self.backoffs[n - 1]
            if n == 1:
                out[left] += logs[0] + np.float32(self.floor)
                break
            wanted = contexts[n - 1][left]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            known = keys[at] == wanted
            out[left[known]] += logs[at[known]]  # an unseen context leaves all weight to the lower order
        return out


class Identifier:
    def __init__(self, models: dict[str, KneserNey]):
        self.langs = sorted(models)
        self.models = [models[lang] for lang in self.langs]
        self.temperature = 1.0
        self.limits = {lang: (0.0, 1.0, 1.0) for lang in self.langs}

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, languages) cross-entropies in nats a character, and the numbers of characters. Texts from :func:`letters_only`."""
        order = self.models[0].order
        pad = " " * (order - 1)
        points, starts = code_points([pad + t for t in texts])
        grams = gram_hashes(points, order)
        at = np.ones(len(points), bool)
        for k in range(order - 1):
            at[starts[:-1] + k] = False
        where = np.flatnonzero(at)
        _, first, inverse = np.unique(grams[where], return_index=True, return_inverse=True)
        ends = where[first]
        hashes = [gram_hashes(points, n)[ends] for n in range(1, order + 1)]
        contexts = [np.zeros(len(ends), np.uint64)] + [gram_hashes(points, n)[ends - 1] for n in range(1, order)]
        lengths = np.array([len(t) for t in texts], np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        out = np.zeros((len(texts), len(self.langs)))
        full = lengths > 0
        for k, model in enumerate(self.models):
            logs = np.concatenate([[0.0], np.cumsum(model.log_probabilities(hashes, contexts)[inverse], dtype=np.float64)])
            out[full, k] = -(logs[bounds[1:]] - logs[bounds[:-1]])[full] / lengths[full]
        return out, lengths

    def calibrate(self, h: np.ndarray, lengths: np.ndarray, langs: list[str]) -> None:
        """From the cross-entropies and lengths of texts and the languages they are in."""
        usable = lengths > 0
        truth = np.array([self.langs.index(lang) for lang in langs])[usable]
        h, lengths = h[usable], lengths[usable]
        losses = []
        grid = 2.0 ** np.arange(-2, 8)
        for t in grid:  # scores are a softmax of -t * entropy; the t of least log loss
            z = -t * (h - h.min(axis=1, keepdims=True))
            losses.append(-(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))).mean() if len(z) else 0.0)
        self.temperature = float(grid[int(np.argmin(losses))])
        for k, lang in enumerate(self.langs):
            own, n = h[truth == k, k], lengths[truth == k]
            if not len(own):
                continue
            mean = float(np.average(own, weights=n))
            error = (own - mean) ** 2
            long = n >= np.median(n)
            between = max(float(error[long].mean()), MIN_SD**2)
            within = float(max(((error - between).clip(0) * n)[~long].mean() if (~long).any() else 0.0, 1.0))
            self.limits[lang] = (mean, between, within)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """(language, score, cross-entropy, rejected) of each text."""
        clean = [letters_only(t) for t in texts]
        if not self.langs or not any(clean):
            return [("und", 0.0, None, True)] * len(texts)
        h, lengths = self.entropies(clean)
        out = []
        for row, n in zip(h, lengths, strict=True):
            if n == 0:
                out.append(("und", 0.0, None, True))
                continue
            k = int(np.argmin(row))
            z = np.exp(-self.temperature * (row - row[k]))
            mean, between, within = self.limits[self.langs[k]]
            limit = mean + REJECT_SD * np.sqrt(between + within / n)
            out.append((self.langs[k], float(1.0 / z.sum()), float(row[k]), bool(row[k] > limit)))
        return out


def held_out_id(name: str) -> Column:
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 5 == 0, F.lit(False))


def held_out() -> Column:
    """Every fifth document by a checksum of its id; a null id is not held out but does not train either."""
    return held_out_id("doc_id")


def training_sample(docs: DataFrame, per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text, part) of about ``per_lang`` different documents a language, chosen by a hash of their id and text; part 0 calibrates.

    A language with up to ``per_lang`` different documents gives all of them, so none is lost, whatever ids they have.
    """
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out()).withColumn("print", F.xxhash64("text"))
    chance = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(per_lang) / F.count_distinct("doc_id", "print")).alias("chance"))
    draw = F.pmod(F.xxhash64("doc_id", "print", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    part = F.pmod(F.xxhash64("doc_id", "print", F.lit(2)), F.lit(5)).cast("int")
    drawn = known.withColumn("draw", draw).join(F.broadcast(chance), "lang").filter("draw < chance")
    return drawn.dropDuplicates(["lang", "doc_id", "print"]).select("lang", "text", part.alias("part"))


def train(docs: DataFrame, per_lang: int = SAMPLE_DOCS, order: int = ORDER) -> Identifier:
    """An identifier of the languages in ``docs`` (doc_id, text, lang). The driver gets the models' arrays, and a row of cross-entropies for each calibration document."""
    drawn = training_sample(docs, per_lang)
    own = drawn.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.count_if(F.col("part") == 0).alias("apart"))
    whole = (F.col("docs") < MIN_DOCS) | (F.col("apart") == 0) | (F.col("apart") == F.col("docs"))
    parts = drawn.join(own.select("lang", whole.alias("whole")), "lang").select("lang", "text", (F.col("whole") | (F.col("part") > 0)).alias("trains"), (F.col("whole") | (F.col("part") == 0)).alias("calibrates"))
    sample = materialize(parts, "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], int] = {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = " " * (order - 1) + letters_only(text)
                for k in range(len(t) - order + 1 if t.strip() else 0):
                    key = lang, t[k : k + order]
                    found[key] = found.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "gram", "n"])

    def build(counted: pa.Table) -> pa.Table:
        model = KneserNey(dict(zip(counted["gram"].to_pylist(), counted["n"].to_pylist(), strict=True)), order)
        arrays = model.arrays()
        return pa.table({
            "lang": pa.array([counted["lang"][0].as_py()] * len(arrays)), "at": pa.array(range(len(arrays)), pa.int32()), "floor": pa.array([model.floor] * len(arrays), pa.float64()),
            "hashes": pa.array([h.tobytes() for h, _ in arrays], pa.binary()), "logs": pa.array([v.tobytes() for _, v in arrays], pa.binary()),
        })

    counted = sample.filter("trains").select("lang", "text").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    arrays: dict[str, list] = {}
    floors: dict[str, float] = {}
    for r in counted.groupBy("lang").applyInArrow(build, "lang string, at int, floor double, hashes binary, logs binary").collect():
        arrays.setdefault(r.lang, []).append((r.at, np.frombuffer(r.hashes, np.uint64), np.frombuffer(r.logs, np.float32)))
        floors[r.lang] = r.floor
    identifier = Identifier({lang: KneserNey.of_arrays([(h, v) for _, h, v in sorted(own, key=lambda x: x[0])], floors[lang]) for lang, own in arrays.items()})
    if not identifier.langs:
        return identifier
    shared = sample.sparkSession.sparkContext.broadcast(identifier)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE, BYTES_AT_ONCE):
            h, lengths = shared.value.entropies([letters_only(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(h), pa.list_(pa.float64())), pa.array(lengths, pa.int64())], ["lang", "h", "length"])

    apart = sample.filter("calibrates").select("lang", "text").mapInArrow(measure, "lang string, h array<double>, length long").filter(F.col("lang").isin(identifier.langs)).collect()
    identifier.calibrate(np.array([r.h for r in apart]).reshape(len(apart), -1), np.array([r.length for r in apart], np.int64), [r.lang for r in apart])
    shared.unpersist()
    return identifier


def identify(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(identifier)
    schema = T.StructType([
        docs.schema["doc_id"],
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE, BYTES_AT_ONCE):
            columns = list(zip(*shared.value.predict(batch.column(1).to_pylist()), strict=True))
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], schema.names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def keep_known(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """The rows whose own text is not rejected, with all their columns; each row is judged for itself."""
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE, BYTES_AT_ONCE):
            known = [not rejected for *_, rejected in shared.value.predict(batch.column(batch.num_columns - 1).to_pylist())]
            own = pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1])
            yield own.filter(pa.array(known, pa.bool_()))

    return docs.select("*", F.col("text").cast("string").alias("__text")).mapInArrow(run, docs.schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
