"""Near-dedup of documents by consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of shingles, over all documents, counted exactly by
   blocks of documents (:mod:`toolgraph.llm.frequencies`), so that nothing that
   grows with the corpus is broadcast and no common shingle is a hot key.
2. A document is its set of five-word shingles with weights tf * idf. Documents
   with the very same set and counts collapse into a class with one
   representative before anything is compared.
3. Improved consistent weighted sampling draws ``BANDS * ROWS`` samples; equal
   samples are as likely as the weighted Jaccard similarity. Its Gamma and
   uniform variables come from bits of one hash a shingle and sample, by
   quantile tables. ``ROWS`` samples make a band; at similarity 0.8 a pair meets
   in some band with probability 0.9998.
4. In a bucket of documents that agree on a band, all are compared with the
   most central one (whose buckets are largest in sum), never all with all; the
   exact weighted Jaccard similarity decides. Linked documents form components.
   Then members of a bucket that are still outside its main component are
   matched with documents of other components by prefix filtering, which is
   exact, so that no link across components goes unchecked although no bucket's
   pairs are ever listed. Common keys are joined by shuffles that adaptive
   execution splits.

Defined results: a text of one to four words is one shingle of all its words; a
null text, or one without words, has no shingle and is a class of its own.
Class ids are the smallest doc_id of a class. Rows repeated under one id count
as one document (their texts should agree); a null doc_id is left out. Extra
columns are ignored by :func:`near_duplicate_classes` and passed on by
:func:`drop_near_duplicates`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.frequencies import Shared, by_planes, corpus_size, document_shingles, from_planes, packed, shared_shingles, unpacked, with_shared
from toolgraph.llm.rows import ids_tell_rows_apart
from toolgraph.llm.shingles import mix
from toolgraph.llm.wordsplit import slices
from toolgraph.operators.components import connected_components
from toolgraph.scratch import drop, materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
#: shingles before a shared one that show whether it is the first
EARLIER = 16
SEED = 0x5DEECE66D
ROWS_AT_ONCE = 128
#: shingles that are sampled at once
SAMPLED_AT_ONCE = 1024


def gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles at the middles of n equal parts of Gamma(2, 1), by bisection of 1 - (1 + x) exp(-x)."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(80):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


_quantiles = gamma_quantiles(1 << 12)
_log_quantiles = np.log(_quantiles)
_odd = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(SEED)) | np.uint64(1)


def weighted_samples(shingles: np.ndarray, log_weights: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """One 64-bit sample for each entry of ``odd``: equal for two weighted sets as often as their weighted Jaccard similarity."""
    best = np.full(len(odd), np.inf)
    chosen = np.zeros(len(odd), np.uint64)
    for at in range(0, len(shingles), SAMPLED_AT_ONCE):
        own, lw = shingles[at : at + SAMPLED_AT_ONCE], log_weights[at : at + SAMPLED_AT_ONCE]
        h = odd[:, None] * own[None, :]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        r = _quantiles[h >> np.uint64(52)]
        beta = (h & np.uint64(0xFFFFFFFF)) * 2.0**-32
        t = np.floor(lw / r + beta)
        a = _log_quantiles[(h >> np.uint64(40)) & np.uint64(0xFFF)] - r * (t - beta + 1.0)
        k = np.argmin(a, axis=1)
        rows = np.arange(len(odd))
        low = a[rows, k]
        better = low < best
        best[better] = low[better]
        chosen[better] = mix(own[k[better]] + np.uint64(SEED) * (t[rows[better], k[better]].astype(np.int64) + 1024).astype(np.uint64))
    return chosen


class Frequencies:
    """Inverse document frequencies: of the shingles given (sorted), and of all others, which one document holds."""

    def __init__(self, documents: int, shingles: np.ndarray, held: np.ndarray):
        self.documents, self.shingles, self.held = documents, shingles, held

    def idf(self, shingles: np.ndarray) -> np.ndarray:
        held = np.ones(len(shingles), np.int64)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
            held = np.where(self.shingles[at] == shingles, self.held[at], 1)
        return np.log1p(self.documents / held)

    def packed(self) -> bytes:
        return packed(self.shingles) + by_planes(self.held.astype(np.uint32))

    @classmethod
    def unpacked(cls, documents: int, data: bytes) -> Frequencies:
        cut = len(data) // 12 * 8
        return cls(documents, unpacked(data[:cut]), from_planes(data[cut:], np.uint32).astype(np.int64))


def document_frequencies(docs: DataFrame, size: int = SHINGLE) -> tuple[int, DataFrame]:
    """Number of documents, and in how many of them each shingle occurs that more than one has, by blocks (:mod:`toolgraph.llm.frequencies`)."""
    n, blocks = corpus_size(docs)
    return n, shared_shingles(docs.select("doc_id", "text"), size, blocks)


def inverse_frequencies(n: int, counts: DataFrame) -> Frequencies:
    """All frequencies in one place: for small tables only."""
    rows = counts.collect()
    found = Shared([bytes(r.shingles) for r in rows], [bytes(r.held) for r in rows])
    return Frequencies(n, found.shingles, found.held)


def with_frequencies(docs: DataFrame, n: int, counts: DataFrame, size: int = SHINGLE, blocks: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """(doc_id, frequencies, counts): the distinct shingles of each text with their document frequencies, and how often each occurs, packed. ``only``: a table of the doc_ids wanted."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("frequencies", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def work(batch: pa.RecordBatch, shared: Shared) -> Iterator[pa.RecordBatch]:
        own = list(document_shingles(batch.column(1), size))
        packs = [Frequencies(n, s, shared.of(s)).packed() for s, _ in own]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packs, pa.binary()), pa.array([by_planes(c.astype(np.uint32)) for _, c in own], pa.binary())], schema.names)

    return with_shared(docs, counts, blocks or corpus_size(docs)[1], work, schema, only)


def signatures(docs: DataFrame, n: int, counts: DataFrame, blocks: int, size: int = SHINGLE) -> DataFrame:
    """(doc_id, print_1, print_2, bands): two hashes of the whole weighted set, and a hash of each band; null without shingles."""
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(f"print_{k}", T.LongType()) for k in (1, 2)], T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(batch: pa.RecordBatch, shared: Shared) -> Iterator[pa.RecordBatch]:
        prints: tuple[list, list] = ([], [])
        bands: list = []
        for shingles, times in document_shingles(batch.column(1), size):
            if not len(shingles):
                bands.append(None)
                prints[0].append(None)
                prints[1].append(None)
                continue
            log_weights = np.log(times * np.log1p(n / shared.of(shingles)))
            samples = weighted_samples(shingles, log_weights, _odd).reshape(BANDS, ROWS)
            code = np.zeros(BANDS, np.uint64)
            for k in range(ROWS):
                code = mix(code + samples[:, k])
            bands.append(code.view(np.int64))
            both = mix(shingles + times.astype(np.uint64) * np.uint64(SEED))
            prints[0].append(int(both.sum().view(np.int64)))
            prints[1].append(int(mix(both).sum().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p, pa.int64()) for p in prints], pa.array(bands, pa.list_(pa.int64()))], schema.names)

    return with_shared(docs, counts, blocks, sign, schema)


def weighted_jaccard(a: np.ndarray, b: np.ndarray, idf: Frequencies) -> float:
    """Of two sorted multisets of shingles."""
    (x, m), (y, n) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return similarity(x, m * idf.idf(x), y, n * idf.idf(y))


def similarity(x: np.ndarray, of_x: np.ndarray, y: np.ndarray, of_y: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of sorted distinct shingles with weights."""
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = float(np.minimum(of_x[i], of_y[j]).sum())
    return both / (float(of_x.sum()) + float(of_y.sum()) - both)


def tfidf(documents: int, frequencies: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, their TF-IDF weights, and their IDF alone, of a row of :func:`with_frequencies`."""
    own = Frequencies.unpacked(documents, frequencies)
    idf = np.log1p(documents / own.held)
    return own.shingles, from_planes(counts, np.uint32) * idf, idf


def verified_links(pairs: DataFrame, sets: DataFrame, documents: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is at least ``threshold``."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("frequencies").alias("of_a"), F.col("counts").alias("n_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("frequencies").alias("of_b"), F.col("counts").alias("n_b"))
    kind = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("similarity", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near = [similarity(*tfidf(documents, x.as_py(), m.as_py())[:2], *tfidf(documents, y.as_py(), k.as_py())[:2]) for x, m, y, k in zip(*batch.columns[2:], strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.float64())], schema.names)
            yield out.filter(pa.array([s >= threshold for s in near], pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "n_a", "of_b", "n_b").mapInArrow(run, schema)


def unchecked_pairs(sets: DataFrame, documents: int, threshold: float) -> DataFrame:
    """(a, b): every pair of a stray with a document of another component that can be similar enough, by prefix filtering.

    ``sets`` has (doc_id, frequencies, counts, component, stray). Shingles stand in one order for all, rarest first. Documents
    whose similarity is t share at least t / (1 + t) of their summed weight, so their first common shingle stands
    within the first 1 - t of either's weight, and neither has more weight before it than the other can do without.
    A common shingle of a large group thus matches only documents that have next to nothing before it. Each shingle
    carries the ``EARLIER`` ones just before it; a match with one of those in common is not a pair's first and is left out.
    """
    schema = T.StructType([*[sets.schema[c] for c in ("doc_id", "component", "stray")], T.StructField("shingle", T.LongType()), T.StructField("left", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("earlier", T.ArrayType(T.LongType()))])
    back = np.arange(EARLIER, 0, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            kept, lefts, weights, earlier, held = [], [], [], [], []
            for frequencies, counts in zip(batch.column(3), batch.column(4), strict=True):
                shingles, own, idf = tfidf(documents, frequencies.as_py(), counts.as_py())
                order = np.lexsort((shingles, -idf))
                w = own[order]
                before = np.concatenate([[0.0], np.cumsum(w)[:-1]])
                n = int((before <= (1 - threshold) * w.sum() + 1e-9).sum())
                kept.append(shingles[order][:n].view(np.int64))
                lefts.append(w.sum() - before[:n])
                weights.append(np.full(n, w.sum()))
                place = np.arange(n)[:, None] - back
                earlier.append(kept[-1][place[place >= 0]])
                held.append(np.minimum(np.arange(n), EARLIER))
            ends = np.concatenate([[0], np.cumsum(np.concatenate(held))]).astype(np.int32)
            before_it = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(earlier)))
            of = pa.array(np.repeat(np.arange(len(kept)), [len(k) for k in kept]))
            columns = [c.take(of) for c in batch.columns[:3]]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(np.concatenate(c)) for c in (kept, lefts, weights)], before_it], schema.names)

    prefixes = materialize(sets.select("doc_id", "component", "stray", "frequencies", "counts").mapInArrow(run, schema), "prefixes")
    x, y = prefixes.filter("stray").alias("x"), prefixes.alias("y")
    enough = (F.col("x.weight") + F.col("y.weight")) * (threshold / (1 + threshold)) - 1e-9
    meet = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component"))
    found = x.join(y, meet & (F.col("x.left") >= enough) & (F.col("y.left") >= enough) & ~F.arrays_overlap("x.earlier", "y.earlier"))
    return found.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def near_duplicate_classes(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: doc_id, class_id (smallest doc_id of its class), class_size, kept (doc_id = class_id)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    n, blocks = corpus_size(docs)
    counts = materialize(shared_shingles(docs, size, blocks), "frequencies")
    signed = materialize(signatures(docs, n, counts, blocks, size), "signatures")

    # aggregates are written before rows are joined to them, so that a join may split its largest groups
    prints = ["print_1", "print_2"]
    firsts = materialize(signed.filter("bands IS NOT NULL").groupBy(*prints).agg(F.min("doc_id").alias("rep")), "firsts")
    member = signed.select("doc_id", *prints).join(firsts, prints, "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep")).distinct()
    member = materialize(member, "members")
    own = signed.join(firsts.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    banded = materialize(own.select("doc_id", F.posexplode("bands").alias("band", "code")).select("doc_id", F.xxhash64("band", "code").alias("bucket")), "banded")
    drop(spark, signed, firsts)
    held = materialize(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "held")
    central = materialize(banded.join(held, "bucket").groupBy("doc_id").agg(F.sum("held").alias("central")), "central")
    rows = materialize(banded.join(held, "bucket").join(central, "doc_id").select("bucket", "doc_id", "central"), "buckets")
    drop(spark, banded, held, central)
    least = F.min(F.struct((-F.col("central")).alias("central"), "doc_id")).alias("least")  # ids of any type that sorts
    leaders = materialize(rows.groupBy("bucket").agg(least).select("bucket", F.col("least.doc_id").alias("leader")), "leaders")
    pairs = materialize(
        rows.join(leaders, "bucket").filter("doc_id <> leader").select(F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b")).distinct(),
        "pairs",
    )
    sets = materialize(with_frequencies(docs, n, counts, size, blocks, only=rows.select("doc_id").distinct()), "shingle-sets")
    drop(spark, counts, leaders)
    links = materialize(verified_links(pairs, sets, n, threshold), "links")
    labels = connected_components(links, "a", "b")

    # what a bucket holds outside its main component may still link to other components
    placed = materialize(rows.join(labels, rows["doc_id"] == labels["node"], "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")), "placed")
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("components"), F.max(F.struct("n", "component")).alias("top")).filter("components > 1")
    main = materialize(main, "main-components")
    stray = F.max(F.col("component") != F.col("top.component")).alias("stray")
    mixed = materialize(placed.join(main, "bucket").groupBy("doc_id", "component").agg(stray), "mixed-documents")
    rest = materialize(unchecked_pairs(sets.join(mixed, "doc_id"), n, threshold).join(pairs, ["a", "b"], "left_anti"), "late-pairs")
    drop(spark, rows, placed, main, mixed, pairs)
    late = materialize(verified_links(rest, sets, n, threshold), "links")
    if not late.isEmpty():
        labels = connected_components(links.union(late), "a", "b")
    drop(spark, sets, rest, links, late)

    classed = member.join(labels, member["rep"] == labels["node"], "left").select("doc_id", F.coalesce("component", "rep").alias("class_id"))
    classed = materialize(classed, "classes")
    drop(spark, member)
    sizes = materialize(classed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")), "class-sizes")
    return classed.join(sizes, "class_id").select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that stay, with all their columns: one of each class, and those without a doc_id. Several texts under one id are judged each for itself."""
    if not ids_tell_rows_apart(docs.filter("doc_id IS NOT NULL").select("doc_id")):
        text = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
        texts = docs.filter("doc_id IS NOT NULL").select("doc_id", F.col("text").cast("string").alias("text"), text.alias("sha")).dropDuplicates(["doc_id", "sha"])
        # numbers in the order of (doc_id, text's digest), so that the smallest doc_id still wins
        texts = materialize(texts.repartitionByRange("doc_id", "sha").sortWithinPartitions("doc_id", "sha").withColumn("row", F.monotonically_increasing_id()), "texts")
        gone = near_duplicate_classes(texts.select(F.col("row").alias("doc_id"), "text"), size, threshold).filter("NOT kept").select(F.col("doc_id").alias("row"))
        gone = texts.join(gone, "row").select(F.col("doc_id").alias("__gone"), F.col("sha").alias("__sha"))
        return docs.join(gone, (docs["doc_id"] == gone["__gone"]) & (text == gone["__sha"]), "left_anti")
    gone = near_duplicate_classes(docs, size, threshold).filter("NOT kept").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
