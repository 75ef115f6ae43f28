"""Similarity join of producers with consumer parameters, in blocks, and the routing of its candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows of either side in one block product
BLOCK = 2048
#: rows of a product are a multiple of this
EVEN = 96
#: groups of either side: a vector is sent to as many tasks as the other side has groups
GROUPS = 16
#: numbers in the vectors of a group; beyond GROUPS full groups their number grows, since a task's memory does not
VALUES = 1 << 23
RECALL, AUTO, TOP_K = 0.7, 0.8, 5


def unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of unit length, from a list column whose lists are equally long; a zero vector stays zero and is similar to nothing."""
    lists = column.combine_chunks()
    v = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    return v / np.where((n := np.linalg.norm(v, axis=1, keepdims=True)) > 0, n, 1.0)


def padded(v: np.ndarray) -> np.ndarray:
    """With zero rows up to a multiple of ``EVEN``: a product's last rows and columns are summed in another order, and equal vectors must score alike."""
    return np.concatenate([v, np.zeros((-len(v) % EVEN, v.shape[1]))])


def best_in_group(consumers: pa.Table, producers: pa.Table, recall: float, k: int, block: int = BLOCK) -> pa.Table:
    """Of each consumer, the k best producers whose cosine is over ``recall``, by products of ``block`` rows of either side."""
    ids = np.array(producers["producer"].to_pylist(), dtype=object)
    rank = np.argsort(ids, kind="stable")  # ties go to the smaller producer: blocks come in this order
    vectors = producers["v"].take(pa.array(rank))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for begin in range(0, consumers.num_rows, block):
        own = padded(unit_rows(consumers["v"].slice(begin, block)))
        rows, cols, best = found[0]
        n = min(block, consumers.num_rows - begin)
        over = np.full(n, recall)  # what a score has to exceed
        for at in range(0, len(ids), block):
            scores = own @ padded(unit_rows(vectors.slice(at, block))).T
            r, c = np.nonzero(scores[:n, : min(block, len(ids) - at)] > over[:, None])
            if not len(r):
                continue
            rows, cols, best = np.concatenate([rows, r]), np.concatenate([cols, c + at]), np.concatenate([best, scores[r, c]])
            order = np.lexsort((cols, -best, rows))  # only what is over it is sorted
            rows, cols, best = rows[order], cols[order], best[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            rows, cols, best, place = (x[place < k] for x in (rows, cols, best, place))
            full = place == k - 1
            over[rows[full]] = best[full]
        found.append((rows + begin, cols, best))
    rows, cols, best = (np.concatenate(x) for x in zip(*found, strict=True))
    taken = pa.array(rows)
    return pa.table({"consumer": consumers["consumer"].take(taken), "param": consumers["param"].take(taken), "producer": pa.array(ids[rank[cols]].tolist(), producers["producer"].type), "score": pa.array(best)})


def n_groups(rows: int, size: int, block: int = BLOCK) -> int:
    """Groups of a side of so many vectors of that size: one a block, but at most ``GROUPS`` while a group holds no more than ``VALUES`` numbers."""
    return max(1, min(GROUPS, -(-rows // block)), -(-rows * size // VALUES))


def top_matches(producers: DataFrame, consumers: DataFrame, recall: float = RECALL, k: int = TOP_K, block: int = BLOCK) -> DataFrame:
    """(producer, consumer, param, score): for each consumer parameter the k most similar producers over ``recall``.

    ``producers`` has (producer, v), ``consumers`` (consumer, param, v); null vectors match nothing. Each side is dealt
    into groups by hash, whose number does not grow with the rows until a group is full; each pair of groups is one task's
    bounded matrix products, of which only k rows a consumer leave.
    """
    kind = lambda d: "array<float>" if d.schema["v"].dataType.elementType.typeName() == "float" else "array<double>"
    producers = producers.filter("v IS NOT NULL").select("producer", F.col("v").cast(kind(producers)).alias("v"))
    consumers = consumers.filter("v IS NOT NULL").select("consumer", "param", F.col("v").cast(kind(consumers)).alias("v"))
    n_p, n_c = (n_groups(*d.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first(), block) for d in (producers, consumers))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = consumers.withColumn("c_group", F.pmod(F.xxhash64("consumer", "param"), F.lit(n_c)).cast("int")).withColumn("p_group", each(n_p))
    right = producers.withColumn("p_group", F.pmod(F.xxhash64("producer"), F.lit(n_p)).cast("int")).withColumn("c_group", each(n_c))
    kinds = {f.name: f.dataType.simpleString() for f in [*consumers.schema, *producers.schema]}
    schema = f"consumer {kinds['consumer']}, param {kinds['param']}, producer {kinds['producer']}, score double"

    def run(c: pa.Table, p: pa.Table) -> pa.Table:
        if not c.num_rows or not p.num_rows:
            return pa.table({"consumer": c["consumer"][:0], "param": c["param"][:0], "producer": p["producer"][:0], "score": pa.array([], pa.float64())})
        return best_in_group(c, p, recall, k, block)

    partial = left.groupBy("c_group", "p_group").cogroup(right.groupBy("c_group", "p_group")).applyInArrow(run, schema)
    best = Window.partitionBy("consumer", "param").orderBy(F.col("score").desc(), "producer")
    return partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("producer", "consumer", "param", "score")


def without_self(matches: DataFrame) -> DataFrame:
    """Drops self-edges; only after the top k were taken, so a self match uses up a place."""
    return matches.filter(F.col("producer") != F.col("consumer"))


def route(score: Column, auto: float = AUTO, verify: bool = True, has_model: bool = True) -> Column:
    """``direct`` from ``auto`` on; below it ``verify`` with a model, ``drop`` without one, ``direct`` if verification is off."""
    middle = "direct" if not verify else "verify" if has_model else "drop"
    return F.when(score >= auto, F.lit("direct")).otherwise(F.lit(middle))


def graph_edges(matches: DataFrame) -> DataFrame:
    """Keyed multi-edges (src, dst, key, relation, parameter, weight); the same key counts once."""
    edges = matches.select(
        F.col("producer").alias("src"),
        F.col("consumer").alias("dst"),
        F.concat(F.col("producer").cast("string"), F.lit("->"), F.col("consumer").cast("string"), F.lit(":"), F.col("param").cast("string")).alias("key"),
        F.lit("provides_parameter").alias("relation"),
        F.col("param").alias("parameter"),
        F.col("score").alias("weight"),
    )
    return edges.dropDuplicates(["src", "dst", "key"])
