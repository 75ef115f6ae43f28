"""Similarity and graph queries over ``embeddings``, ``lineitem`` and ``events``.

The driver tables hold no tool catalogue, so vectors stand in for tools: labels
below 5 produce and the others consume, or all do both; a vector's label is the
parameter. Similarity in this data is low, so thresholds are 0.25 to 0.35.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolgraph.functions.hashing import edge_signature, skeleton_id, uniform
from toolgraph.operators import graph, sampling, similarity
from toolgraph.scratch import materialize

RECALL, AUTO, EDGE = 0.25, 0.35, 0.35


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, sf_dir, "embeddings")
    return v.select(F.col("vec_id").alias("producer"), F.col("embedding").alias("v"), "label"), v.select(F.col("vec_id").alias("consumer"), F.col("label").cast("string").alias("param"), F.col("embedding").alias("v"), "label")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    producers, consumers = vectors(spark, sf_dir)
    return similarity.without_self(similarity.top_matches(producers.filter("label < 5"), consumers.filter("label >= 5"), RECALL))


def proxy_edges(spark: SparkSession, sf_dir: str, recall: float = EDGE) -> DataFrame:
    edges = similarity.graph_edges(similarity.without_self(similarity.top_matches(*vectors(spark, sf_dir), recall)))
    return materialize(edges.withColumn("weight", F.round("weight", 6)), "proxy-edges")


def proxy_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("name"))


def sim_topk_edges(spark, sf_dir):
    found = candidates(spark, sf_dir)
    return found.select("producer", "consumer", "param", F.round("score", 6).alias("score"), similarity.route(F.col("score"), AUTO).alias("route"))


def sim_self_slot(spark, sf_dir):
    return proxy_edges(spark, sf_dir, 0.3)


def route_counts(spark, sf_dir):
    found = materialize(candidates(spark, sf_dir).select("score"), "scores")
    settings = [("verify_with_model", True, True), ("verify_without_model", True, False), ("no_verify", False, True)]
    routed = found.select(F.explode(F.array(*[F.struct(F.lit(n).alias("setting"), similarity.route(F.col("score"), AUTO, v, m).alias("route")) for n, v, m in settings])).alias("r"))
    return routed.groupBy("r.setting", "r.route").agg(F.count(F.lit(1)).alias("n"))


def graph_degree_top(spark, sf_dir):
    degree = materialize(graph.degrees(proxy_edges(spark, sf_dir)), "degrees")
    sides = [graph.top(degree.select("name", F.col(c).alias("degree")), "degree").withColumn("side", F.lit(c)) for c in ("out_degree", "in_degree")]
    return sides[0].unionByName(sides[1]).select("side", "name", "degree")


def graph_param_top(spark, sf_dir):
    return graph.top(graph.parameter_counts(proxy_edges(spark, sf_dir)), "n").select("name", "n")


def graph_stats(spark, sf_dir):
    return graph.statistics(proxy_nodes(spark, sf_dir), proxy_edges(spark, sf_dir))


def graph_components(spark, sf_dir):
    return graph.components_of(proxy_nodes(spark, sf_dir), proxy_edges(spark, sf_dir))


def graph_prune(spark, sf_dir):
    nodes, edges = proxy_nodes(spark, sf_dir), proxy_edges(spark, sf_dir)
    pairs = graph.prune(nodes, edges, 2).select(F.lit(2).alias("min_size"), "name")
    return pairs.union(graph.prune(nodes, edges, 4).select(F.lit(4).alias("min_size"), "name"))


def edge_multi(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("producer"), F.col("l_partkey").alias("consumer"), F.col("l_linenumber").cast("string").alias("param"), F.lit(1.0).alias("score"))
    keyed = similarity.graph_edges(lines)
    return keyed.groupBy(F.col("src").alias("name")).agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("dst").alias("targets"), F.count_distinct("parameter").alias("parameters"))


def simple_paths(spark, sf_dir):
    found = graph.simple_paths(proxy_edges(spark, sf_dir), 2, 4)
    return found.select(F.array_join(F.transform("path", lambda x: x.cast("string")), "->").alias("path"), "n_nodes")


def skeleton_dedup(spark, sf_dir):
    steps = lambda e: F.struct(e["from"].cast("string").alias("from"), e["to"].cast("string").alias("to"))
    paths = graph.simple_paths(proxy_edges(spark, sf_dir), 2, 3).withColumn("edges", F.transform(graph.path_edges(F.col("path")), steps))
    signed = paths.select(edge_signature("edges").alias("signature"), skeleton_id("edges").alias("id"))
    return signed.groupBy("id", "signature").agg(F.count(F.lit(1)).alias("n"))


def edge_visits(spark, sf_dir) -> DataFrame:
    """Visits of the proxy edges: events of the user whose id is the edge's source."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("visits"))


def decay_weights(spark, sf_dir):
    edges = proxy_edges(spark, sf_dir)
    visits = edges.select("src", "key").join(edge_visits(spark, sf_dir), F.col("src") == F.col("user_id")).select("key", "visits")
    return sampling.weighted_edges(edges, visits).select("key", F.round("decayed", 9).alias("decayed"))


def hop_draw(spark, sf_dir):
    edges = proxy_edges(spark, sf_dir).withColumn("decayed", F.col("weight"))
    walks = edges.select(F.col("src").cast("string").alias("walk"), F.col("src").alias("at")).distinct()
    return sampling.next_hops(walks, edges, 1, 7)


def walks(spark, sf_dir):
    edges = proxy_edges(spark, sf_dir).withColumn("decayed", F.col("weight"))
    begin = edges.select(F.concat(F.lit("w"), F.col("src").cast("string")).alias("walk"), F.col("src").alias("at")).distinct()
    found = sampling.walk(begin, edges, 2, 4, 7)
    return found.select("walk", F.array_join(F.transform("path", lambda x: x.cast("string")), "->").alias("path"), F.size("path").alias("n_nodes"), "wanted")


def core_sets(edges: DataFrame) -> DataFrame:
    """(sample, name): each edge's ends as a sample."""
    return edges.select(F.col("key").alias("sample"), F.explode(F.array("src", "dst")).alias("name")).distinct()


def neighbours_minus_core(spark, sf_dir):
    edges = proxy_edges(spark, sf_dir)
    return graph.neighbours(edges, core_sets(edges))


def negatives(spark, sf_dir):
    """Of each sample, how many distractors it got, how many of them are its neighbours, and which."""
    edges = proxy_edges(spark, sf_dir)
    chosen = sampling.distractors(core_sets(edges), edges, proxy_nodes(spark, sf_dir), 0.5, 7)
    names = F.array_sort(F.collect_list(F.when(F.col("tier") == 0, F.col("name"))))  # as many as a sample asks for
    return chosen.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tier") == 0).alias("hard"), F.array_join(names, ",").alias("hard_names"))


def coverage(spark, sf_dir):
    edges = proxy_edges(spark, sf_dir)
    begun = edges.filter("weight >= 0.38").select("key", F.when(F.col("weight") >= 0.4, 1).otherwise(0).cast("long").alias("visits"))
    return sampling.coverage_ratios(edges, begun)


def hash_uniforms(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", uniform(11, "o_orderkey", F.col("o_custkey")).alias("u"))


def generated_skeletons(spark, sf_dir):
    edges = proxy_edges(spark, sf_dir)
    nodes = proxy_nodes(spark, sf_dir).select("name", F.concat(F.lit("vector "), F.col("name").cast("string")).alias("description"), F.lit("general").alias("category"))
    made, _ = sampling.sample_skeletons(nodes, edges, "neighborhood", 100, 2, 4, batch=64, seed=3)
    return made


QUERIES = {f.__name__: f for f in (
    sim_topk_edges, sim_self_slot, route_counts, graph_degree_top, graph_param_top, graph_stats, graph_components, graph_prune, edge_multi, simple_paths,
    skeleton_dedup, decay_weights, hop_draw, walks, neighbours_minus_core, negatives, coverage, hash_uniforms, generated_skeletons,
)}

COS = "list_cosine_similarity(p.embedding::DOUBLE[], c.embedding::DOUBLE[])"


def proxy_sql(recall: float = EDGE) -> str:
    return f"""m AS (SELECT p.vec_id AS src, c.vec_id AS dst, c.label AS label, {COS} AS score FROM embeddings p, embeddings c),
r AS (SELECT *, row_number() OVER (PARTITION BY dst, label ORDER BY score DESC, src) AS k FROM m WHERE score > {recall}),
e AS (SELECT src, dst, src || '->' || dst || ':' || label AS key, 'provides_parameter' AS relation, CAST(label AS VARCHAR) AS parameter, round(score, 6) AS weight
      FROM r WHERE k <= 5 AND src <> dst)"""


CANDIDATES = f"""m AS (SELECT p.vec_id AS producer, c.vec_id AS consumer, CAST(c.label AS VARCHAR) AS param, {COS} AS score
  FROM embeddings p, embeddings c WHERE p.label < 5 AND c.label >= 5),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY consumer, param ORDER BY score DESC, producer) AS k FROM m WHERE score > {RECALL}) WHERE k <= 5 AND producer <> consumer)"""
U = lambda *keys: f"((CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 13) AS BIGINT) + 1) / 4503599627370496.0)"
COMPONENTS = f"""{proxy_sql()},
both_ways AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
comp AS (SELECT a AS name, min(b) AS component FROM reach GROUP BY a)"""


def walk_sql() -> str:
    parts = [proxy_sql(), "starts AS (SELECT DISTINCT 'w' || src AS walk, src AS spot FROM e)",
             f"s0 AS (SELECT walk, spot, CAST(2 + floor({U(chr(39) + '7' + chr(39), 'walk', chr(39) + 'length' + chr(39))} * 3 - 1e-12) AS INT) AS wanted, [spot] AS path, FALSE AS stopped FROM starts)"]
    for k in range(1, 4):
        u = U("'7'", "s.walk", f"'{k}'", "e.key")
        parts.append(f"h{k} AS (SELECT s.walk, arg_min(e.dst, -ln({u}) / e.weight) AS dst FROM s{k - 1} s JOIN e ON e.src = s.spot WHERE NOT s.stopped AND len(s.path) < s.wanted GROUP BY s.walk)")
        free = "(h.dst IS NOT NULL AND NOT list_contains(s.path, h.dst))"
        parts.append(f"s{k} AS (SELECT s.walk, CASE WHEN {free} THEN h.dst ELSE s.spot END AS spot, s.wanted, CASE WHEN {free} THEN list_append(s.path, h.dst) ELSE s.path END AS path, s.stopped OR (NOT {free} AND len(s.path) < s.wanted) AS stopped FROM s{k - 1} s LEFT JOIN h{k} h ON h.walk = s.walk)")
    return f"WITH {', '.join(parts)} SELECT walk, array_to_string(path, '->') AS path, CAST(len(path) AS INT) AS n_nodes, wanted FROM s3"


CORE = "core AS (SELECT DISTINCT key AS sample, src AS name FROM e UNION SELECT DISTINCT key, dst FROM e)"
NEAR = "near AS (SELECT DISTINCT c.sample, x.name FROM core c JOIN (SELECT src AS a, dst AS name FROM e UNION SELECT dst, src FROM e) x ON x.a = c.name WHERE NOT EXISTS (SELECT 1 FROM core k WHERE k.sample = c.sample AND k.name = x.name))"
DEGREE = "d AS (SELECT n.vec_id AS name, (SELECT count(*) FROM e WHERE src = n.vec_id) AS o, (SELECT count(*) FROM e WHERE dst = n.vec_id) AS i FROM embeddings n)"
top_text = lambda metric, value, source: f"SELECT '{metric}' AS metric, string_agg(name || '(' || n || ')', ', ' ORDER BY n DESC, name) AS value FROM (SELECT name, {value} AS n FROM {source} ORDER BY n DESC, name LIMIT 5)"
ORACLE = {
    "sim_topk_edges": f"WITH {CANDIDATES} SELECT producer, consumer, param, round(score, 6) AS score, CASE WHEN score >= {AUTO} THEN 'direct' ELSE 'verify' END AS route FROM c",
    "sim_self_slot": f"WITH {proxy_sql(0.3)} SELECT * FROM e",
    "route_counts": f"""WITH {CANDIDATES}, s AS (SELECT unnest(['verify_with_model', 'verify_without_model', 'no_verify']) AS setting)
SELECT setting, CASE WHEN score >= {AUTO} OR setting = 'no_verify' THEN 'direct' WHEN setting = 'verify_with_model' THEN 'verify' ELSE 'drop' END AS route, count(*) AS n FROM c, s GROUP BY 1, 2""",
    "graph_degree_top": f"""WITH {proxy_sql()}, d AS (SELECT 'out_degree' AS side, src AS name, count(*) AS degree FROM e GROUP BY src UNION ALL SELECT 'in_degree', dst, count(*) FROM e GROUP BY dst)
SELECT side, name, degree FROM (SELECT *, row_number() OVER (PARTITION BY side ORDER BY degree DESC, name) AS k FROM d) WHERE k <= 5""",
    "graph_param_top": f"WITH {proxy_sql()} SELECT parameter AS name, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, name LIMIT 5",
    "graph_stats": f"""WITH RECURSIVE {COMPONENTS}, z AS (SELECT component, count(*) AS n FROM comp GROUP BY 1), {DEGREE}, pc AS (SELECT parameter AS name, count(*) AS n0 FROM e GROUP BY 1),
t AS (SELECT (SELECT count(*) FROM embeddings) AS nodes, (SELECT count(*) FROM e) AS edges)
SELECT 'nodes' AS metric, CAST(nodes AS VARCHAR) AS value FROM t UNION ALL SELECT 'edges', CAST(edges AS VARCHAR) FROM t
UNION ALL SELECT 'density', printf('%.5f', edges::DOUBLE / (nodes * (nodes - 1))) FROM t
UNION ALL SELECT 'components', CAST(count(*) AS VARCHAR) FROM z UNION ALL SELECT 'largest_component', CAST(max(n) AS VARCHAR) FROM z
UNION ALL SELECT 'isolates', CAST(count(*) FILTER (n = 1) AS VARCHAR) FROM z
UNION ALL {top_text('top_producers', 'o', 'd')} UNION ALL {top_text('top_consumers', 'i', 'd')} UNION ALL {top_text('top_parameters', 'n0', 'pc')}""",
    "graph_components": f"WITH RECURSIVE {COMPONENTS} SELECT name, component FROM comp",
    "graph_prune": f"""WITH RECURSIVE {COMPONENTS}, z AS (SELECT component, count(*) AS n FROM comp GROUP BY 1), s AS (SELECT unnest([2, 4]) AS min_size)
SELECT CAST(min_size AS INT) AS min_size, name FROM comp JOIN z USING (component), s WHERE n >= min_size""",
    "edge_multi": "SELECT l_suppkey AS name, count(DISTINCT l_partkey || ':' || l_linenumber) AS edges, count(DISTINCT l_partkey) AS targets, count(DISTINCT l_linenumber) AS parameters FROM lineitem GROUP BY 1",
    "simple_paths": f"""WITH {proxy_sql()}, s AS (SELECT DISTINCT src, dst FROM e), p2 AS (SELECT [src, dst] AS p FROM s),
p3 AS (SELECT list_append(p, dst) AS p FROM p2 JOIN s ON s.src = p[-1] WHERE NOT list_contains(p, dst)), p4 AS (SELECT list_append(p, dst) AS p FROM p3 JOIN s ON s.src = p[-1] WHERE NOT list_contains(p, dst))
SELECT array_to_string(p, '->') AS path, CAST(len(p) AS INT) AS n_nodes FROM (SELECT p FROM p2 UNION ALL SELECT p FROM p3 UNION ALL SELECT p FROM p4)""",
    "skeleton_dedup": f"""WITH {proxy_sql()}, s AS (SELECT DISTINCT src, dst FROM e),
g AS (SELECT src || '->' || dst AS signature FROM s UNION ALL SELECT array_to_string(list_sort([a.src || '->' || a.dst, b.src || '->' || b.dst]), '|') FROM s a JOIN s b ON b.src = a.dst WHERE b.dst <> a.src)
SELECT 'skel_' || md5(signature) AS id, signature, count(*) AS n FROM g GROUP BY signature""",
    "decay_weights": f"""WITH {proxy_sql()}, v AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT key, round(weight / (1.0::DOUBLE + coalesce(n, 0)), 9) AS decayed FROM e LEFT JOIN v ON v.user_id = e.src""",
    "hop_draw": f"WITH {proxy_sql()}, race AS (SELECT CAST(src AS VARCHAR) AS walk, key, dst, row_number() OVER (PARTITION BY src ORDER BY -ln({U(chr(39) + '7' + chr(39), 'src', chr(39) + '1' + chr(39), 'key')}) / weight, key) AS k FROM e) SELECT walk, key, dst FROM race WHERE k = 1",
    "walks": walk_sql(),
    "neighbours_minus_core": f"WITH {proxy_sql()}, {CORE}, {NEAR} SELECT sample, name FROM near",
    "negatives": f"""WITH {proxy_sql()}, {CORE}, {NEAR},
k AS (SELECT sample, name, row_number() OVER (PARTITION BY sample ORDER BY {U("'7'", "sample", "name")}, name) AS k FROM near),
h AS (SELECT sample, count(*) AS hard, string_agg(name, ',' ORDER BY name) AS hard_names FROM k WHERE k <= 2 GROUP BY 1)
SELECT s.sample, CAST(2 AS BIGINT) AS n, coalesce(hard, 0)::BIGINT AS hard, coalesce(hard_names, '') AS hard_names FROM (SELECT DISTINCT sample FROM core) s LEFT JOIN h USING (sample)""",
    "coverage": f"""WITH {proxy_sql()}, t AS (SELECT (SELECT count(*) FROM e) AS edges, count(*) AS edges_considered, count(*) FILTER (weight >= 0.4) AS edges_traversed FROM e WHERE weight >= 0.38)
SELECT *, printf('%.2f%%', edges_considered * 100.0::DOUBLE / edges) AS considered, printf('%.2f%%', edges_traversed * 100.0::DOUBLE / edges) AS traversed FROM t""",
    "hash_uniforms": f"SELECT o_orderkey, CAST({U(chr(39) + '11' + chr(39), 'o_orderkey', 'o_custkey')} AS DOUBLE) AS u FROM orders",
}
