"""Coverage-aware sampling of task skeletons from the dependency graph, in batches of walks.

A walk draws its hops from edge weights that decay with earlier visits. Every
random number is a hash of (seed, walk, step, edge), so a run repeats on any
partitioning. A batch of walks draws against the counters as they stood before
it: a batch of one is the sequential sampler, larger ones trade its feedback for
parallelism. Rounds and their counters are written tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolgraph.functions.hashing import skeleton_id, uniform
from toolgraph.operators.graph import neighbours
from toolgraph.scratch import materialize

DEFAULT_WEIGHT = 0.5


def decayed(weight: Column, visits: Column) -> Column:
    return F.coalesce(weight, F.lit(DEFAULT_WEIGHT)) / (1.0 + F.coalesce(visits, F.lit(0)))


def weighted_edges(edges: DataFrame, visits: DataFrame) -> DataFrame:
    """Edges with ``decayed``: weight / (1 + visits). ``visits``: (key, visits)."""
    return edges.join(visits, "key", "left").withColumn("decayed", decayed(F.col("weight"), F.col("visits"))).drop("visits")


def race(seed: int, step: int) -> Column:
    """Order in which a walk's edges arrive: the first is drawn in proportion to its weight; edges of weight zero only among themselves. Null where there is no edge."""
    u = uniform(seed, "walk", step, "key")
    time = -F.ln(u) / F.when(F.col("decayed") > 0, F.col("decayed")).otherwise(1.0)
    return F.when(F.col("key").isNotNull(), F.struct((F.col("decayed") <= 0).alias("zero"), time.alias("time"), F.col("key")))


def next_hops(walks: DataFrame, edges: DataFrame, step: int, seed: int = 0) -> DataFrame:
    """(walk, key, dst): of each walk at ``at``, one outgoing edge drawn by weight, as an exponential race.

    If all weights are zero, all edges are alike. A walk at a dead end has no row.
    """
    met = walks.select("walk", "at").join(edges.select("src", "dst", "key", "decayed"), F.col("at") == F.col("src"))
    return met.groupBy("walk").agg(F.min_by(F.struct("key", "dst"), race(seed, step)).alias("hop")).select("walk", "hop.key", "hop.dst")


def starts(edges: DataFrame, node_visits: DataFrame, batch: int, round_: int = 0, seed: int = 0) -> DataFrame:
    """(walk, at): the ``batch`` least visited nodes that have an edge out; equals in random order."""
    nodes = edges.select(F.col("src").alias("at")).distinct().join(node_visits, F.col("at") == node_visits["name"], "left")
    order = F.coalesce(F.col("visits"), F.lit(0)) + uniform(seed, round_, "at")
    return nodes.withColumn("order", order).orderBy("order", "at").limit(batch).select(F.concat_ws("/", F.lit(str(round_)), F.col("at").cast("string")).alias("walk"), "at")


def walk(begin: DataFrame, edges: DataFrame, min_len: int, max_len: int, seed: int = 0) -> DataFrame:
    """(walk, path, keys, stopped, wanted): walks of at most ``wanted`` nodes, which is uniform in [min_len, max_len].

    A walk ends at a dead end, and when it draws a node that it has already visited; it does not draw again.
    """
    wanted = (F.lit(min_len) + F.floor(uniform(seed, "walk", F.lit("length")) * (max_len - min_len + 1) - 1e-12)).cast("int")
    state = begin.withColumn("wanted", wanted).select("walk", "at", "wanted", F.array("at").alias("path"), F.array().cast("array<string>").alias("keys"), F.lit(False).alias("stopped"))
    out = edges.select("src", "dst", "key", "decayed")
    for step in range(1, max_len):
        # one join and one aggregate a step: each walk meets the edges out of where it is, and keeps the first of the race
        going = ~F.col("stopped") & (F.size("path") < F.col("wanted"))
        hop = F.min_by(F.struct("key", "dst"), race(seed, step)).alias("hop")
        moved = state.join(out, going & (F.col("at") == F.col("src")), "left").groupBy("walk").agg(F.first(F.struct("at", "wanted", "path", "keys", "stopped")).alias("s"), hop)
        moved = moved.select("walk", "s.*", F.col("hop.key").alias("hop_key"), F.col("hop.dst").alias("dst"))
        free = F.col("dst").isNotNull() & ~F.array_contains("path", F.col("dst"))
        state = moved.select(
            "walk",
            F.when(free, F.col("dst")).otherwise(F.col("at")).alias("at"),
            "wanted",
            F.when(free, F.concat("path", F.array("dst"))).otherwise(F.col("path")).alias("path"),
            F.when(free, F.concat("keys", F.array("hop_key"))).otherwise(F.col("keys")).alias("keys"),
            (F.col("stopped") | (~free & (F.size("path") < F.col("wanted")))).alias("stopped"),
        )
    return state.select("walk", "path", "keys", "stopped", "wanted")


def distractors(core: DataFrame, edges: DataFrame, pool: DataFrame, ratio: float = 0.5, seed: int = 0) -> DataFrame:
    """(sample, name, tier): int(core nodes * ratio) + 1 nodes that are not core; neighbours (tier 0) before random ones (tier 1).

    ``core``: (sample, name); ``pool``: (name). Random nodes come from a window of the pool's hash order that starts at
    the sample's own hash and is as long as can be needed, so no sample meets the whole pool.
    """
    near = neighbours(edges, core).withColumn("tier", F.lit(0))
    extras = core.groupBy("sample").agg(F.count(F.lit(1)).alias("size")).withColumn("extras", F.floor(F.col("size") * ratio).cast("int") + 1)
    total = pool.count()
    slot = F.row_number().over(Window.partitionBy("shard").orderBy(uniform(seed, "name"), "name")) - 1
    shards = max(1, total // 4096)
    dealt = pool.select("name").distinct().withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards))).withColumn("slot", slot)
    held = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    asked = extras.withColumn("shard", F.pmod(F.xxhash64("sample"), F.lit(shards))).join(held, "shard").withColumn("first", F.floor(uniform(seed, "sample") * F.col("held") - 1e-12).cast("int"))
    need = F.least(F.col("held"), F.col("extras") + F.col("size") + F.col("extras")).cast("int")
    probes = asked.select("sample", "shard", F.explode(F.transform(F.sequence(F.lit(0), need - 1), lambda k: F.pmod(F.col("first") + k, F.col("held")).cast("int"))).alias("slot"))
    random = probes.join(dealt, ["shard", "slot"]).select("sample", "name").join(core, ["sample", "name"], "left_anti").join(near, ["sample", "name"], "left_anti").withColumn("tier", F.lit(1))
    order = Window.partitionBy("sample").orderBy("tier", uniform(seed, "sample", "name"), "name")
    ranked = near.unionByName(random).withColumn("rank", F.row_number().over(order)).join(extras, "sample")
    return ranked.filter("rank <= extras").select("sample", "name", "tier")


def format_skeletons(walks: DataFrame, nodes: DataFrame, negatives: DataFrame | None = None, pattern: str = "sequential", edges: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """(sample, pattern, nodes, edges, meta): nodes with their roles, edges with steps from 1 and their parameter; meta only with negatives.

    ``walks``: (walk, path, keys); nodes without a description or category get ``""`` and ``general``. ``edges``: (key,
    parameter); without them, or without keys, parameters are null. With negatives the nodes stand in a random order,
    which a hash of (seed, sample, name) draws, so that their place does not tell their role.
    """
    core = walks.select(F.col("walk").alias("sample"), F.posexplode("path").alias("pos", "name")).withColumn("role", F.lit("core"))
    every = core.withColumn("place", F.col("pos").cast("double"))
    if negatives is not None:
        others = negatives.select("sample", F.lit(1 << 20).alias("pos"), "name", F.lit("distractor").alias("role"))
        every = core.unionByName(others).withColumn("place", uniform(seed, "sample", "name"))
    known = nodes.select("name", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("category", F.lit("general")).alias("category"))
    entry = F.struct("place", "pos", "name", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("category", F.lit("general")).alias("category"), "role")
    listed = every.join(known, "name", "left").groupBy("sample").agg(F.array_sort(F.collect_list(entry)).alias("listed"))
    paths = walks.select(F.col("walk").alias("sample"), "path")
    if edges is not None and "keys" in walks.columns:
        taken = walks.select(F.col("walk").alias("sample"), F.posexplode("keys").alias("at", "key")).join(edges.select("key", "parameter").dropDuplicates(["key"]), "key", "left")
        held = taken.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("at", F.col("parameter").cast("string").alias("parameter")))).alias("given"))
        paths = paths.join(held, "sample", "left")
    else:
        paths = paths.withColumn("given", F.lit(None).cast("array<struct<at:int,parameter:string>>"))
    parameter = lambda k: F.try_element_at("given", k)["parameter"]
    steps = F.transform(
        F.sequence(F.lit(1), F.size("path") - 1),
        lambda k: F.struct(k.alias("step"), F.element_at("path", k).alias("from"), F.element_at("path", k + 1).alias("to"), F.struct(parameter(k).alias("parameter"), F.lit("provides_input_for").alias("relation")).alias("dependency")),
    )
    named = F.filter("listed", lambda n: n["role"] == "distractor")
    meta = F.struct(F.col("path").alias("core_chain_nodes"), F.transform(named, lambda n: n["name"]).alias("distractor_nodes")) if negatives is not None else F.lit(None).cast("struct<core_chain_nodes:array<string>,distractor_nodes:array<string>>")
    shown = F.transform("listed", lambda n: F.struct(n["name"].alias("name"), n["description"].alias("description"), n["category"].alias("category"), n["role"].alias("role")))
    return listed.join(paths, "sample").select("sample", F.lit(pattern).alias("pattern"), shown.alias("nodes"), F.when(F.size("path") > 1, steps).otherwise(F.slice(steps, 1, 0)).alias("edges"), meta.alias("meta"))


@dataclass
class Coverage:
    """Counters that outlive calls: (key, visits) of edges, with zero for those only considered, and (name, visits) of starts."""

    edge_visits: DataFrame
    node_visits: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession, edges: DataFrame) -> Coverage:
        return cls(spark.createDataFrame([], "key string, visits long"), edges.select(F.col("src").alias("name"), F.lit(0).cast("long").alias("visits")).limit(0))

    def add(self, keys: DataFrame, names: DataFrame) -> Coverage:
        """``keys``: (key, visits) to add, ``names``: (name, visits) to add."""
        fold = lambda old, new, by: materialize(old.unionByName(new).groupBy(by).agg(F.sum("visits").alias("visits")), "coverage")
        return Coverage(fold(self.edge_visits, keys, "key"), fold(self.node_visits, names, "name"))


def coverage_ratios(edges: DataFrame, edge_visits: DataFrame) -> DataFrame:
    """(edges, edges_considered, edges_traversed, considered, traversed): both counters, and as percent text; 0 without edges."""
    seen = edge_visits.agg(F.count(F.lit(1)).alias("edges_considered"), F.count_if(F.col("visits") > 0).alias("edges_traversed"))
    both = edges.agg(F.count(F.lit(1)).alias("edges")).crossJoin(seen)  # one row each
    text = lambda c: F.format_string("%.2f%%", F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("edges")), F.lit(0.0)))
    return both.withColumns({"considered": text("edges_considered"), "traversed": text("edges_traversed")})


def generate(edges: DataFrame, count: int, min_len: int, max_len: int, coverage: Coverage | None = None, batch: int = 256, max_idle_rounds: int = 8, seed: int = 0) -> tuple[DataFrame, Coverage]:
    """Up to ``count`` walks (walk, path, keys, id) with distinct fingerprints, and the coverage after them.

    Walks below ``min_len`` are rejected and count a visit on their start; duplicates count nothing; accepted walks count
    on their start and each edge. Stops after ``max_idle_rounds`` rounds without a new fingerprint.
    """
    spark = edges.sparkSession
    edges = materialize(edges.select("src", "dst", "key", "weight"), "walk-edges")
    coverage = coverage or Coverage.empty(spark, edges)
    kept: DataFrame | None = None
    have = idle = round_ = 0
    while have < count and idle < max_idle_rounds:
        live = weighted_edges(edges, coverage.edge_visits)
        drawn = materialize(walk(starts(edges, coverage.node_visits, batch, round_, seed), live, min_len, max_len, seed + round_), "walks")
        steps = F.transform(F.sequence(F.lit(1), F.size("keys")), lambda k: F.struct(F.element_at("path", k).cast("string").alias("from"), F.element_at("path", k + 1).cast("string").alias("to")))
        long = drawn.filter(F.size("path") >= min_len).withColumn("id", skeleton_id(F.when(F.size("keys") > 0, steps).otherwise(F.slice(steps, 1, 0))))
        first = long.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("walk"))).filter("nth = 1").drop("nth")
        new = first if kept is None else first.join(kept, "id", "left_anti")
        new = materialize(new.orderBy("walk").limit(count - have).select("walk", "path", "keys", "id"), "skeletons")
        short = drawn.filter(F.size("path") < min_len)
        considered = edges.join(drawn.select(F.explode("path").alias("src")).distinct(), "src", "left_semi").select("key", F.lit(0).cast("long").alias("visits"))
        walked = new.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("visits"))
        begun = new.select(F.col("path")[0].alias("name")).union(short.select(F.col("path")[0])).groupBy("name").agg(F.count(F.lit(1)).alias("visits"))
        coverage = coverage.add(considered.unionByName(walked), begun)
        gained = new.count()
        kept = new if kept is None else materialize(kept.unionByName(new), "skeletons")
        have, idle, round_ = have + gained, 0 if gained else idle + 1, round_ + 1
    kind = edges.schema["src"].dataType.simpleString()
    return kept if kept is not None else spark.createDataFrame([], f"walk string, path array<{kind}>, keys array<string>, id string"), coverage


#: what a mode calls its skeletons
PATTERNS = {"chain": "sequential", "neighborhood": "neighborhood_subgraph"}


def sample_skeletons(
    nodes: DataFrame, edges: DataFrame, mode: str = "neighborhood", count: int = 10, min_len: int = 3, max_len: int = 6, expansion_ratio: float = 0.5, coverage: Coverage | None = None, batch: int = 256, seed: int = 0
) -> tuple[DataFrame, Coverage]:
    """Up to ``count`` skeletons of distinct fingerprints, and the coverage after them.

    ``chain`` gives walks alone, ``neighborhood`` adds distractors: neighbours of the chain first, then random nodes. An
    unknown mode draws nothing. ``nodes``: (name, description, category).
    """
    if mode not in PATTERNS:
        count = 0
    kept, after = generate(edges, count, min_len, max_len, coverage, batch, seed=seed)
    negatives = None
    if mode == "neighborhood":
        core = kept.select(F.col("walk").alias("sample"), F.explode("path").alias("name"))
        negatives = distractors(core, edges, nodes.select("name"), expansion_ratio, seed)
    return format_skeletons(kept, nodes, negatives, PATTERNS.get(mode, mode), edges, seed), after
