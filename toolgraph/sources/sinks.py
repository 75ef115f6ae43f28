"""Checkpoints as directories of tables, JSON and GraphML exports, chat files, progress lists."""

from __future__ import annotations

from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_checkpoint(path: str, **tables: DataFrame) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_checkpoint(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    """The tables that are there; empty if there is no checkpoint."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = {n: jvm.org.apache.hadoop.fs.Path(f"{path}/{n}") for n in names}
    return {n: spark.read.parquet(f"{path}/{n}") for n, p in at.items() if p.getFileSystem(conf).exists(p)}


def write_node_link(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Node-link JSON lines in two folders, ``nodes`` and ``links``, that tasks write in parallel."""
    nodes.withColumnRenamed("name", "id").write.mode("overwrite").json(f"{path}/nodes")
    edges.withColumnsRenamed({"src": "source", "dst": "target"}).write.mode("overwrite").json(f"{path}/links")


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(line): GraphML elements of nodes and edges; nested attributes as JSON text. Header and footer are :data:`GRAPHML`."""
    as_text = lambda df, c: F.to_json(c) if df.schema[c].dataType.typeName() in ("struct", "array", "map") else F.col(c).cast("string")
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    data = lambda df, skip: F.concat_ws("", *[F.concat(F.lit(f"<data key={quoteattr(c)}>"), safe(as_text(df, c)), F.lit("</data>")) for c in df.columns if c not in skip])
    ns = nodes.select(F.concat(F.lit('<node id="'), safe(F.col("name").cast("string")), F.lit('">'), data(nodes, {"name"}), F.lit("</node>")).alias("line"))
    es = edges.select(F.concat(F.lit('<edge source="'), safe(F.col("src").cast("string")), F.lit('" target="'), safe(F.col("dst").cast("string")), F.lit('">'), data(edges, {"src", "dst"}), F.lit("</edge>")).alias("line"))
    return ns.union(es)


def graphml_head(nodes: DataFrame, edges: DataFrame) -> str:
    keys = [f"<key id={quoteattr(c)} for={quoteattr(kind)} attr.name={quoteattr(c)} attr.type=\"string\"/>" for kind, df, skip in (("node", nodes, {"name"}), ("edge", edges, {"src", "dst"})) for c in df.columns if c not in skip]
    return '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">' + "".join(keys) + f'<graph edgedefault={quoteattr("directed")} id={quoteattr(escape("tools"))}>'


GRAPHML_END = "</graph></graphml>"


def node_link_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, at, line): a node-link document of a directed multigraph, line by line, in the order of (part, at)."""

    def listed(part: int, df: DataFrame, *order: str) -> DataFrame:
        line = F.to_json(F.struct(*df.columns))
        rows = df.select(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in order], line).alias("at"), line.alias("line"))
        least = rows.agg(F.min("at").alias("least"))  # one row: the entry without a comma before it
        return rows.crossJoin(least).select(F.lit(part).alias("part"), "at", F.when(F.col("at") == F.col("least"), F.col("line")).otherwise(F.concat(F.lit(","), "line")).alias("line"))

    ns, es = nodes.withColumnRenamed("name", "id"), edges.withColumnsRenamed({"src": "source", "dst": "target"})
    fixed = [(0, "", '{"directed":true,"multigraph":true,"graph":{},"nodes":['), (2, "", '],"links":['), (4, "", "]}")]
    marks = nodes.sparkSession.createDataFrame(fixed, "part int, at string, line string")
    return marks.unionByName(listed(1, ns, "id")).unionByName(listed(3, es, "source", "target"))


def graphml_document(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, at, line): a GraphML document, line by line, in the order of (part, at)."""
    ends = nodes.sparkSession.createDataFrame([(0, "", graphml_head(nodes, edges)), (2, "", GRAPHML_END)], "part int, at string, line string")
    return ends.unionByName(graphml_lines(nodes, edges).select(F.lit(1).alias("part"), F.concat(F.when(F.col("line").startswith("<node"), F.lit("1 ")).otherwise(F.lit("2 ")), "line").alias("at"), "line"))


def write_document(lines: DataFrame, path: str) -> None:
    """Text files whose names sort in the order of the lines, so that read one after the other they are one document."""
    lines.repartitionByRange("part", "at").sortWithinPartitions("part", "at").select("line").write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines without null fields."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def write_trajectories(trajectories: DataFrame, path: str, key: str = "intent_id") -> None:
    """One folder an intent."""
    trajectories.repartition(key).write.mode("overwrite").option("ignoreNullFields", True).partitionBy(key).json(path)


def append_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string")).write.mode("append").text(path)


def write_scores(df: DataFrame, path: str) -> None:
    df.select("Experiment", *[c for c in df.columns if c not in ("Experiment", "row_ord")]).write.mode("overwrite").option("header", True).csv(path)
