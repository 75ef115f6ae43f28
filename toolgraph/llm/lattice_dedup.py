"""Near-dedup of embeddings by hashing to E8 lattice points.

Vectors of one label are projected to eight dimensions at random, scaled, and
decoded to the nearest point of the E8 lattice, one to four times over: these
points together are a table's cell. Each vector also probes the neighbouring
cells that its residuals point to. Vectors that meet in a cell, one of them at
home there, are compared by cosine in double precision, in blocks of matrix
products.

Points a cell, scale, probes and number of tables are chosen for each label by
its number of distinct vectors, to the next power of two: of those tried, the
ones of least cost in rows sent and pairs compared. The number of tables follows
from the hit rate at the threshold, simulated, so that a pair right at the
threshold is missed with probability ``MISS`` at most. Several points a cell keep
the tables few: a few for a label of 10^5 vectors, some 50 for one of 10^9.

Equal vectors collapse into one with a count of copies first. Then only ids move,
each with the signs of 128 random projections: cells with one vector, or with
nobody at home, fall out, and of the others those vectors stay whose signs agree
with another's as well as two at the threshold would (again but for ``MISS``).
Only these are sent to their cells as vectors. Cells with more rows than a block
are cut into chunks, and every pair of chunks is its own task's group, so no
group is unbounded and no pair is emitted: tasks return, for each vector, how
many vectors it links to there and one link towards its smallest partner. A pair
that meets in several tables counts in the first; to tell, the codes of linked
vectors are made again.

Defined results: a label or vector that is null, a zero vector, and vectors with
null or non-finite components link with nothing (n_links 0, their own
component). Labels of any type are compared as they are. Vectors of different
lengths link with nothing of each other. Rows repeated under one id are vectors
like any others: they link with each other if they are near enough. A null vec_id (ids are whole numbers) keeps its
row, takes part in nothing and has a null component. Other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.shingles import mix
from toolgraph.operators.components import connected_components
from toolgraph.scratch import drop, materialize

THRESHOLD = 0.93
MISS = 1e-5
#: rows of a cell that are compared as one block
BLOCK = 1024
#: what a plan is chosen from
SCALES = (0.25, 0.3125, 0.4, 0.5, 0.6)
POINTS = (1, 2, 3, 4)
PROBES = (2, 8, 24)
#: neighbours of a point that probes choose from
NEARBY = 3
#: microseconds to find a lattice point, to send an id to a cell, and to compare its signs with another's there
DECODE, SEND, COMPARE = 8.0, 4.0, 0.006
SIGNS = 128
#: rows whose signs are compared at once with all of their group
TILE = 512


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    r = np.rint(x)
    e = x - r
    rows = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    k = np.abs(e[rows]).argmax(axis=1)
    r[rows, k] += np.where(e[rows, k] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 shifted by one half everywhere."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest lattice vectors."""
    whole = [(i, j, s, t) for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    out = np.zeros((len(whole), 8))
    for row, (i, j, s, t) in zip(out, whole, strict=True):
        row[i], row[j] = s, t
    halves = np.array([h for h in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in h) % 2 == 0])
    return np.vstack([out, halves])


def projection(dim: int, tables: int, scale: float) -> np.ndarray:
    """(dim, 8 * tables): coordinates of a unit vector have standard deviation ``scale``."""
    return np.random.default_rng(dim).normal(size=(tables, dim, 8)).transpose(1, 0, 2).reshape(dim, -1) * scale


def cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, 1 + NEARBY) hashes of lattice points, home first, then the neighbours in the direction of the residual; and how much farther each is than home, squared."""
    home = nearest_e8(x)
    toward = (x - home) @ neighbours().T
    best = np.argpartition(-toward, NEARBY, axis=1)[:, :NEARBY]
    points = np.concatenate([home[:, None, :], home[:, None, :] + neighbours()[best]], axis=1)
    twice = (points * 2).astype(np.int64).astype(np.uint64)
    code = np.zeros(twice.shape[:2], np.uint64)
    for k in range(8):
        code = mix(code + twice[:, :, k])
    return code, np.concatenate([np.zeros((len(x), 1)), 2 - 2 * np.take_along_axis(toward, best, axis=1)], axis=1)


#: how a label is hashed: tables, lattice points a cell, probes, scale
Plan = tuple[int, int, int, float]


def cell_codes(unit: np.ndarray, plan: Plan, label: np.ndarray) -> np.ndarray:
    """(rows, tables, 1 + probes) 64-bit codes of cells, home first; table and label are part of the code."""
    tables, points, probes, scale = plan
    projected = unit @ projection(unit.shape[1], tables * points, scale)
    choices = np.array(list(itertools.product(range(1 + NEARBY), repeat=points)))
    out = np.zeros((len(unit), tables, 1 + probes), np.uint64)
    for t in range(tables):
        found = [cells(projected[:, 8 * k : 8 * k + 8]) for k in range(t * points, (t + 1) * points)]
        farther = sum(cost[:, choices[:, k]] for k, (_, cost) in enumerate(found))
        farther[:, 0] = -1.0  # home comes first
        n = min(probes, len(choices) - 1)
        taken = np.argpartition(farther, n, axis=1)[:, : n + 1] if n + 1 < len(choices) else np.tile(np.arange(len(choices)), (len(unit), 1))
        taken = np.take_along_axis(taken, np.argsort(np.take_along_axis(farther, taken, axis=1), axis=1, kind="stable"), axis=1)
        code = mix(np.full(taken.shape, t + 1, np.uint64))
        for k, (hashes, _) in enumerate(found):
            code = mix(code + np.take_along_axis(hashes, choices[:, k][taken], axis=1))
        out[:, t, : n + 1] = mix(code ^ label[:, None])
        out[:, t, n + 1 :] = out[:, t, :1]
    return out.view(np.int64)


@lru_cache(maxsize=256)
def rates(dim: int, threshold: float, points: int, scale: float) -> tuple[tuple[float, ...], float]:
    """How often two vectors at the threshold meet in one table, for each of ``PROBES``, and about how often two vectors have the same home by chance."""
    rng = np.random.default_rng(8)
    u = rng.normal(size=(800, max(dim, 2)))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
    v = threshold * u + np.sqrt(1 - threshold**2) * w
    a, b = (cell_codes(x, (1, points, max(PROBES), scale), np.zeros(len(u), np.uint64))[:, 0] for x in (u, v))
    hits = tuple(float(meets(a[:, : 1 + n], b[:, : 1 + n]).mean()) for n in PROBES)  # nearest cells come first
    if points > 1:
        return hits, rates(dim, threshold, 1, scale)[1] ** points
    home = Counter(a[:, 0].tolist())
    return hits, max(sum(n * (n - 1) for n in home.values()), 1) / (len(u) * (len(u) - 1))


def plan(rows: int, dim: int, threshold: float = THRESHOLD) -> Plan:
    """The plan of least cost for a label of so many distinct vectors."""
    found = []
    for points, scale in itertools.product(POINTS, SCALES):
        hits, chance = rates(dim, threshold, points, scale)
        for probes, hit in zip(PROBES, hits, strict=True):
            width = min(1 + probes, (1 + NEARBY) ** points)
            tables = max(1, int(np.ceil(np.log(MISS) / np.log(1 - min(max(hit, 1e-6), 0.999)))))
            met = min(chance * width, 1.0) * rows
            found.append((tables * (points * DECODE + width * SEND + met * COMPARE), tables, points, width - 1, scale))
    return min(found)[1:]


def most_flips(threshold: float) -> int:
    """How many of 128 signs two vectors at the threshold have different, at most, but for ``MISS``."""
    p = math.acos(threshold) / math.pi
    tail, k = 1.0, -1
    while tail > MISS:
        k += 1
        tail -= math.comb(SIGNS, k) * p**k * (1 - p) ** (SIGNS - k)
    return k


def signs(unit: np.ndarray) -> np.ndarray:
    """(rows, 2): signs of random projections, packed."""
    above = unit @ np.random.default_rng([unit.shape[1], 1]).normal(size=(unit.shape[1], SIGNS)) > 0
    return np.packbits(above, axis=1).view(np.uint64)


def meets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of two (pairs, 1 + probes) code arrays meet in a cell."""
    return (a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)


def unit_vectors(v: pa.Array, dim: int) -> np.ndarray:
    x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares within range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def link_block(table: pa.Table, threshold: float, of_plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, copies linked, smallest id of the vectors' component) for the rows of one group.

    The group holds the rows of chunks a and b of one cell; pairs within a chunk belong to the group a = b.
    """
    table = table.combine_chunks()
    ids, copies, chunk, at_home = (table[c].to_numpy() for c in ("rep", "copies", "chunk", "home"))
    cell, a, b, t, dim = (table[c][0].as_py() for c in ("cell", "a", "b", "table", "dim"))
    unit = unit_vectors(table["v"].combine_chunks(), dim)
    x, y = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
    near = unit[x] @ unit[y].T >= threshold
    near &= at_home[x][:, None] | at_home[y][None, :]
    near &= (ids[x][:, None] < ids[y][None, :]) if a == b else (ids[x][:, None] != ids[y][None, :])
    i, j = np.nonzero(near)
    i, j = x[i], y[j]
    linked, low = np.zeros(len(ids), np.int64), ids.copy()
    if not len(i):
        return ids, linked, low
    some, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    codes = cell_codes(unit[some], of_plan, table["label_hash"].to_numpy()[some].view(np.uint64))
    p, q = place[: len(i)], place[len(i) :]
    first = np.ones(len(i), bool)
    for earlier in range(t):
        first &= ~meets(codes[p, earlier], codes[q, earlier])
    # in this table the pair meets at one's home or at both; then the smaller id's home counts
    home_i, home_j = codes[p, t, 0] == cell, codes[q, t, 0] == cell
    low_is_i = ids[i] < ids[j]
    high_home = np.where(low_is_i, codes[q, t, 0], codes[p, t, 0])
    low_codes = np.where(low_is_i[:, None], codes[p, t], codes[q, t])
    low_at_home = np.where(low_is_i, home_i, home_j)
    low_probes_high = (low_codes == high_home[:, None]).any(axis=1)
    first &= (home_i & home_j) | ~low_at_home | ~low_probes_high
    np.add.at(linked, i[first], copies[j[first]])
    np.add.at(linked, j[first], copies[i[first]])
    while True:
        old = low.copy()
        np.minimum.at(low, i, old[j])
        np.minimum.at(low, j, low[i])
        if (low == old).all():
            return ids, linked, low


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (cell, a, b); they come one group after the other. Groups of one row fall out."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("cell", "a", "b")], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if begin == end:
                continue
            if key is not None and tuple(keys[begin]) != key:
                if sum(h.num_rows for h in held) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            key = tuple(keys[begin])
            held.append(batch.slice(begin, end - begin))
    if sum(h.num_rows for h in held) > 1:
        yield pa.Table.from_batches(held)


def partnered(rows: DataFrame, threshold: float) -> DataFrame:
    """The rows (cell, a, b, chunk, rep, home, table, signs_1, signs_2) whose signs agree well enough with those of another row of the group that they may be compared with."""
    flips = most_flips(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            chunk, home, *own = (table[c].to_numpy() for c in ("chunk", "home", "signs_1", "signs_2"))
            a, b = table["a"][0].as_py(), table["b"][0].as_py()
            some = np.zeros(len(chunk), bool)
            y = np.flatnonzero(chunk == b)
            for at in range(0, len(chunk), TILE):
                x = at + np.flatnonzero(chunk[at : at + TILE] == a)
                near = sum(np.bitwise_count(s[x][:, None] ^ s[y][None, :]) for s in (o.view(np.uint64) for o in own)) <= flips
                near &= home[x][:, None] | home[y][None, :]
                near &= x[:, None] != y[None, :]
                some[x] |= near.any(axis=1)
                some[y] |= near.any(axis=0)
            if some.any():
                yield from table.filter(pa.array(some)).to_batches()

    return rows.mapInArrow(run, rows.schema)


def links_in_cells(rows: DataFrame, threshold: float, plans: dict[tuple[int, int], Plan]) -> DataFrame:
    """(rep, linked, low) from rows that are sorted by group within their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            ids, linked, low = link_block(table, threshold, plans[table["dim"][0].as_py(), table["size_class"][0].as_py()])
            some = (linked > 0) | (low != ids)
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[some], pa.int64()) for x in (ids, linked, low)], ["rep", "linked", "low"])

    return rows.mapInArrow(run, "rep long, linked long, low long")


def cell_rows(distinct: DataFrame, plans: dict[tuple[int, int], Plan]) -> DataFrame:
    """(cell, rep, table, home, signs_1, signs_2): the cells of each vector, its own and those it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                kinds = np.stack([batch.column(c).to_numpy() for c in ("dim", "size_class")], axis=1)
                for dim, size in np.unique(kinds, axis=0).tolist():
                    own = batch.filter(pa.array((kinds == [dim, size]).all(axis=1)))
                    unit = unit_vectors(own.column("v"), dim)
                    codes = cell_codes(unit, plans[dim, size], own.column("label_hash").to_numpy().view(np.uint64))
                    n, tables, width = codes.shape
                    of = np.repeat(np.arange(n), tables * width)
                    columns = [own.column("rep").take(pa.array(of)), pa.array(np.tile(np.repeat(np.arange(tables), width), n), pa.int32()), pa.array(np.tile(np.arange(width) == 0, n * tables))]
                    marks = signs(unit).view(np.int64)[of]
                    yield pa.RecordBatch.from_arrays([pa.array(codes.ravel()), *columns, *[pa.array(np.ascontiguousarray(marks[:, k])) for k in (0, 1)]], ["cell", "rep", "table", "home", "signs_1", "signs_2"])

    return distinct.select("rep", "v", "dim", "size_class", "label_hash").mapInArrow(run, "cell long, rep long, table int, home boolean, signs_1 long, signs_2 long")


def lattice_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType
    v = F.col("embedding") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType)) else F.col("embedding").cast("array<double>")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), "label")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    prints = ["label", "dim", "print_1", "print_2"]
    keyed = vectors.withColumns({"dim": F.size("v").cast("long"), "print_1": F.xxhash64("v"), "print_2": F.xxhash64(F.lit(1), "v")})
    member = materialize(keyed.select("vec_id", sound.alias("sound"), *prints), "vectors")
    distinct = materialize(keyed.filter(sound).groupBy(*prints).agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")).withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    # the next power of two of a label's vectors; the driver sees which of them there are
    sizes = materialize(distinct.groupBy("label", "dim").agg(F.ceil(F.log2(F.count(F.lit(1)))).cast("long").alias("size_class")), "label-sizes")
    plans = {(r.dim, r.size_class): plan(2**r.size_class, r.dim, threshold) for r in sizes.select("dim", "size_class").distinct().collect()}
    sized = distinct.join(sizes, ["label", "dim"]).select("rep", "copies", "v", "dim", "size_class", F.xxhash64("label", "dim").alias("label_hash"))

    ids = materialize(cell_rows(sized, plans), "cell-ids")
    met = ids.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("lived_in")).filter("n > 1 AND lived_in")
    met = materialize(met.select("cell", F.ceil(F.col("n") / BLOCK).alias("chunks")), "met-cells")
    rows = ids.join(met, "cell").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    rows = rows.withColumn("other", other).withColumns({"a": F.least("chunk", "other"), "b": F.greatest("chunk", "other")}).drop("other", "chunks")
    group = ["cell", "a", "b"]
    some = partnered(rows.repartition(*group).sortWithinPartitions(*group), threshold)
    used = materialize(some.groupBy("rep").agg(F.collect_list(F.struct(*group, "chunk", "table", "home")).alias("own")), "own-cells")
    rows = sized.join(used, "rep").select("rep", "copies", "v", "dim", "size_class", "label_hash", F.explode("own").alias("own")).select("*", "own.*").drop("own")
    found = materialize(links_in_cells(rows.repartition(*group).sortWithinPartitions(*group), threshold, plans), "lattice-links")
    drop(spark, ids, met, used, sizes)

    counts = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    labels = connected_components(found.filter("low <> rep"), "rep", "low")
    placed = distinct.select(*prints, "rep", "low_id", "copies").join(labels, F.col("rep") == labels["node"], "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = materialize(placed.groupBy("component").agg(F.min("low_id").alias("component_id")), "components")
    summary = placed.join(lowest, "component").join(counts, "rep", "left").select(*prints, (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    summary = materialize(summary, "summary")  # written before the join, which may then split the commonest vectors
    drop(spark, found, distinct)
    linked = member.filter("sound").join(summary, prints).select("vec_id", "n_links", "component_id")
    alone = member.filter("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lowest AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, e.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM embeddings e LEFT JOIN counted USING (vec_id) LEFT JOIN lowest USING (vec_id)
"""
