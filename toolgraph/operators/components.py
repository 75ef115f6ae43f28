"""Weakly connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolgraph.scratch import drop, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): every node that an edge touches, and the smallest node reachable from it.

    Minimum labels flow over edges and then jump along labels, so long chains
    close in a logarithmic number of rounds. Each round is a written table; the
    driver only sees a count of changed labels. Edges with a null end are
    ignored, self-loops give a component of one; no edges give an empty result.
    """
    links = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src IS NOT NULL AND dst IS NOT NULL")
    both = materialize(links.union(links.select("dst", "src")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        offered = both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("component").alias("low"))
        lower = labels.join(offered, labels["node"] == offered["src"]).select("node", "component", F.least("component", "low").alias("new"))
        parent = labels.select(F.col("node").alias("at"), F.col("component").alias("next"))
        jumped = lower.join(parent, lower["new"] == parent["at"]).select(
            "node", F.least("new", "next").alias("component"), (F.least("new", "next") < F.col("component")).alias("changed")
        )
        step = materialize(jumped, "labels")
        drop(labels.sparkSession, labels)
        labels = step.select("node", "component")
        if step.filter("changed").isEmpty():
            return labels
