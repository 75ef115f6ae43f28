"""The dependency graph as two DataFrames, nodes (name, ...) and edges (src, dst, key, relation, parameter, weight)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolgraph.operators.components import connected_components


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(name, out_degree, in_degree); parallel edges count each, nodes without edges (if given) have zeros."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("src").alias("name"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("name"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("end"))
    counted = ends.groupBy("end.name").agg(F.sum("end.o").alias("out_degree"), F.sum("end.i").alias("in_degree"))
    if nodes is None:
        return counted
    zero = F.lit(0).cast("long")
    return nodes.select("name").join(counted, "name", "left").select("name", F.coalesce("out_degree", zero).alias("out_degree"), F.coalesce("in_degree", zero).alias("in_degree"))


def top(df: DataFrame, by: str, n: int = 5, tie: str = "name") -> DataFrame:
    """The ``n`` rows of largest ``by``; ties go to the smaller ``tie``. Null names are left out."""
    return df.filter(F.col(tie).isNotNull()).orderBy(F.col(by).desc(), tie).limit(n)


def parameter_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.coalesce("parameter", F.lit("unknown")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


def components_of(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, component) of every node; a node without edges is its own component."""
    labels = connected_components(edges)
    return nodes.select("name").join(labels, nodes["name"] == labels["node"], "left").select("name", F.coalesce("component", "name").alias("component"))


def prune(nodes: DataFrame, edges: DataFrame, min_component_size: int = 2) -> DataFrame:
    """The nodes in weak components of at least that size; for 2 that is a semi join with the edges' ends."""
    if min_component_size <= 1:
        return nodes
    if min_component_size == 2:
        joined = edges.filter("src <> dst").select(F.explode(F.array("src", "dst")).alias("name"))
        return nodes.join(joined, "name", "left_semi")
    member = components_of(nodes, edges)
    large = member.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_component_size)
    return nodes.join(member.join(large, "component").select("name"), "name", "left_semi")


def statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(metric, value): nine rows of text. Lists are ``name(count)`` of the five largest."""
    member = components_of(nodes, edges)
    sizes = member.groupBy("component").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("components"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.count_if(F.col("n") == 1).alias("isolates")
    )
    totals = nodes.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(edges.agg(F.count(F.lit(1)).alias("edges"))).crossJoin(sizes)  # one row each
    density = F.coalesce(F.try_divide(F.col("edges").cast("double"), F.col("nodes") * (F.col("nodes") - 1)), F.lit(0.0))
    text = lambda c: F.col(c).cast("string")
    scalars = totals.select(F.explode(F.create_map(
        F.lit("nodes"), text("nodes"), F.lit("edges"), text("edges"), F.lit("density"), F.format_string("%.5f", density),
        F.lit("components"), text("components"), F.lit("largest_component"), text("largest"), F.lit("isolates"), text("isolates"),
    )).alias("metric", "value"))
    degree = degrees(edges, nodes)
    lists = [("top_producers", degree.select("name", F.col("out_degree").alias("n"))), ("top_consumers", degree.select("name", F.col("in_degree").alias("n"))), ("top_parameters", parameter_counts(edges))]
    texts = [
        top(d, "n").select(F.lit(metric).alias("metric"), F.struct((-F.col("n")).alias("down"), F.col("name"), F.format_string("%s(%d)", F.col("name").cast("string"), "n").alias("text")).alias("entry"))
        .groupBy("metric").agg(F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["text"]), ", ").alias("value"))
        for metric, d in lists
    ]
    return reduce(DataFrame.unionByName, texts, scalars)


def neighbours(edges: DataFrame, core: DataFrame) -> DataFrame:
    """(sample, name): successors and predecessors of each sample's core nodes that are not core themselves. ``core``: (sample, name)."""
    forward = core.join(edges, core["name"] == edges["src"]).select("sample", F.col("dst").alias("name"))
    back = core.join(edges, core["name"] == edges["dst"]).select("sample", F.col("src").alias("name"))
    return forward.union(back).distinct().join(core, ["sample", "name"], "left_anti")


def simple_paths(edges: DataFrame, min_nodes: int, max_nodes: int) -> DataFrame:
    """(path, n_nodes): every path without a repeated node; parallel edges are one step. One join a step."""
    steps = edges.select("src", "dst").distinct().filter("src <> dst")
    paths = steps.select(F.array("src", "dst").alias("path"))
    found = [paths]
    for _ in range(max_nodes - 2):
        last = F.element_at("path", -1)
        paths = paths.withColumn("at", last).join(steps, F.col("at") == steps["src"]).filter(~F.array_contains("path", F.col("dst"))).select(F.concat("path", F.array("dst")).alias("path"))
        found.append(paths)
    wanted = found[max(0, min_nodes - 2) :]
    return reduce(DataFrame.union, wanted).select("path", F.size("path").alias("n_nodes"))


def path_edges(path, relation: str = "provides_input_for"):
    """The steps of a path as array<struct<step, from, to, relation>>, counted from 1."""
    return F.transform(
        F.sequence(F.lit(1), F.size(path) - 1),
        lambda k: F.struct(k.alias("step"), F.element_at(path, k).alias("from"), F.element_at(path, k + 1).alias("to"), F.lit(relation).alias("relation")),
    )
