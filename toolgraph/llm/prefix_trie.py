"""A prefix trie over conversations, from partial tries that merge.

A node is a distinct sequence of the first ``d`` turns. Its key is its depth and
two 64-bit hashes, each the exclusive or of one hash a turn of (position, digest
of role and text), so a turn's key follows from what stands before it by one
more exclusive or, in any number of parts.

1. Turns become digests and are range-sorted by (conversation, turn); a
   conversation may spread over many range partitions. Positions and keys are
   running values inside one (conversation, partition), plus what the parts
   before it carry, so a conversation with a third of all turns is split.
2. Each partition of the resulting paths is combined into a *partial trie*, one
   row a node: members, smallest member, words of the last turn, and the list of
   the conversations that end there, cut into slices of ids so that no row grows
   with a hot node. Round by round, ``fan_in`` partial tries merge by a hash of
   the node: members are summed, lists joined. A hot node has one row a partial trie.
3. The rollup runs bottom-up along chains. Nodes with one smallest member ``m``
   are the lower end of m's path, so suffix sums along depth give what lies
   below a node on its chain, and the whole of a chain is added once to each node
   above its top, which m's own path names. That is one row a turn at most,
   however deep the trie is, and needs no round per level.

Defined results: turns are ordered by turn (null first), ties by the digest of
role and text. Turns repeated exactly are separate turns. A null role or text is
empty. Rows of a null conv_id are left out. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolgraph.llm.mixing import words
from toolgraph.scratch import drop, materialize

FAN_IN = 64
#: an end list is cut into slices of 2 ** SLICE_BITS neighbouring ids
SLICE_BITS = 16
#: a chain is summed in blocks of so many nodes
CHAIN_BLOCK = 1 << 16
#: conversations of one block of ids share the head of its first
FAMILY, HEADS = 20, 4
NODE = ["depth", "k1", "k2"]


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest of role and text, words of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.unhex(F.sha2(whole, 256)).alias("digest"), words(F.col("text").cast("string")).alias("words"))


def numbered(digests: DataFrame) -> DataFrame:
    """(conv_id, part, pos from 1, digest, words): each turn's place in its conversation. ``part``: the range partition it stands in."""
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = materialize(digests.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "ranged-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("conv_id", "part").count().select("conv_id", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    placed = materialize(
        ranged.withColumn("within", within).join(parts, ["conv_id", "part"]).select("conv_id", "part", (F.col("before") + F.col("within")).alias("pos"), "digest", "words"), "turns"
    )
    drop(digests.sparkSession, ranged)
    return placed


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the first of their block of ids: their turns (conv_id, part, depth, digest, words, length), and (conv_id, length)."""
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = (
        placed.filter((F.col("conv_id") == family) & (F.col("pos") < HEADS))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    )
    convs = placed.groupBy("conv_id").count().withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")).withColumn("family", family)
    convs = convs.join(heads, "family", "left").withColumn("head", F.when((F.col("h") > 0) & F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))))
    taken = F.coalesce(F.size("head"), F.lit(0))
    taken = F.when(taken < 0, 0).otherwise(taken)
    convs = convs.select("conv_id", "h", "head", taken.alias("taken"), (taken + F.greatest(F.col("count") - F.col("h"), F.lit(0))).alias("length"))
    convs = materialize(convs, "conversations")
    parts = placed.select("conv_id", "part").distinct().join(convs.drop("head"), "conv_id")
    own = placed.join(parts, ["conv_id", "part"]).filter("pos > h")
    own = own.select("conv_id", "part", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "words", "length")
    first = convs.select("conv_id", "length", F.posexplode("head").alias("at", "t"))
    first = first.select("conv_id", F.lit(-1).alias("part"), (F.col("at") + 1).cast("long").alias("depth"), "t.digest", "t.words", "length")
    return own.unionByName(first), convs


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a conversation and depth, the root's (depth 0) included: conv_id, node, p1 and p2 (its parent's hashes), words of the last turn, whether the conversation ends here."""
    hashed = turns.withColumns({"f1": F.xxhash64("depth", "digest"), "f2": F.xxhash64(F.lit("second"), "depth", "digest")})
    within = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = materialize(hashed.withColumns({"x1": F.bit_xor("f1").over(within), "x2": F.bit_xor("f2").over(within)}).drop("digest"), "running-keys")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = running.groupBy("conv_id", "part").agg(F.bit_xor("f1").alias("t1"), F.bit_xor("f2").alias("t2"))
    carried = carried.select("conv_id", "part", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(c) for t, c in (("t1", "c1"), ("t2", "c2"))])
    keyed = running.join(carried, ["conv_id", "part"]).withColumns({"k1": F.col("x1").bitwiseXOR(F.col("c1")), "k2": F.col("x2").bitwiseXOR(F.col("c2"))})
    below = keyed.select(
        "conv_id", *NODE, F.col("k1").bitwiseXOR(F.col("f1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("f2")).alias("p2"), "words", (F.col("depth") == F.col("length")).alias("ends")
    )
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("words"), (F.col("length") == 0).alias("ends"))
    found = materialize(below.unionByName(root), "paths")
    drop(turns.sparkSession, running)
    return found


def partial_tries(rows: DataFrame, slice_bits: int) -> DataFrame:
    """Each partition's nodes, combined where they stand."""
    return (
        rows.withColumn("run", F.spark_partition_id())
        .withColumn("slice", F.when(F.col("ends"), F.shiftright("conv_id", slice_bits)))
        .groupBy("run", *NODE, "slice")
        .agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            *[F.max(c).alias(c) for c in ("words", "p1", "p2")],
            F.array_sort(F.collect_list(F.when(F.col("ends"), F.col("conv_id")))).alias("ended"),
        )
    )


def merge_tries(tries: DataFrame, fan_in: int) -> DataFrame:
    """One round: ``fan_in`` neighbouring partial tries become one."""
    return (
        tries.withColumn("run", (F.col("run") / fan_in).cast("int"))
        .groupBy("run", *NODE, "slice")
        .agg(
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            *[F.max(c).alias(c) for c in ("words", "p1", "p2")],
            F.array_sort(F.flatten(F.collect_list("ended"))).alias("ended"),
        )
    )


def merged_trie(rows: DataFrame, fan_in: int = FAN_IN, slice_bits: int = SLICE_BITS) -> DataFrame:
    """The tree merge: one row a node and slice of its end list (null: members that go on)."""
    trie = materialize(partial_tries(rows, slice_bits), "partial-tries")
    width = (trie.agg(F.max("run")).first()[0] or 0) + 1
    while width > 1:
        trie, merged = materialize(merge_tries(trie, fan_in), "partial-tries"), trie
        drop(rows.sparkSession, merged)
        width = -(-width // fan_in)
    return trie


def streamed_digests(slices: DataFrame) -> DataFrame:
    """SHA-256 of end lists of several slices, read in order, one slice at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("streamed", pa.string())])
        done = lambda: pa.RecordBatch.from_pylist([dict(zip(schema.names, (*node, digest.hexdigest()), strict=True))], schema=schema)
        for batch in batches:
            for row in batch.to_pylist():
                own = tuple(row[c] for c in NODE)
                if own != node:
                    if node is not None:
                        yield done()
                    node, digest = own, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, row["ended"])).encode())
        if node is not None:
            yield done()

    ordered = slices.select(*NODE, "slice", "ended").repartition(*NODE).sortWithinPartitions(*NODE, "slice")
    return ordered.mapInArrow(run, "depth long, k1 long, k2 long, streamed string")


def rolled_up(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens, parent_conv_id): sums over each node's subtree, bottom-up along chains."""
    summed = ["leaf", "saved"]
    block = nodes.withColumn("block", F.floor(F.col("depth") / CHAIN_BLOCK))
    upwards = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = block.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in summed])
    totals = totals.select("conv_id", "block", *[F.coalesce(F.sum(c).over(deeper), F.lit(0)).alias(f"deeper_{c}") for c in summed])
    on_chain = block.select("conv_id", "block", *NODE, *[F.sum(c).over(upwards).alias(f"own_{c}") for c in summed]).join(totals, ["conv_id", "block"])
    on_chain = on_chain.select(*NODE, *[(F.col(f"own_{c}") + F.col(f"deeper_{c}")).alias(f"chain_{c}") for c in summed])

    chains = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "k1", "k2", "p1", "p2")).alias("top"), *[F.sum(c).alias(c) for c in summed])
    chains = materialize(chains, "chains")  # so that adaptive execution splits the largest conversation of the join
    above = rows.join(chains.select("conv_id", F.col("top.depth").alias("top_depth"), *summed), "conv_id").filter("depth < top_depth")
    above = above.groupBy(*NODE).agg(*[F.sum(c).alias(f"above_{c}") for c in summed])

    tops = chains.filter("top.depth > 0").select("top", (F.col("top.depth") - 1).alias("depth"), F.col("top.p1").alias("k1"), F.col("top.p2").alias("k2"))
    parents = tops.join(nodes.select(*NODE, F.col("conv_id").alias("parent")), NODE).select("top.depth", "top.k1", "top.k2", "parent")
    every = lambda c: (F.col(f"chain_{c}") + F.coalesce(F.col(f"above_{c}"), F.lit(0))).cast("long")
    return (
        on_chain.join(above, NODE, "left").join(parents, NODE, "left").select(*NODE, every("leaf").alias("n_leaves"), every("saved").alias("saved_tokens"), "parent")
    )


def ids_text(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda c: c.cast("string")), ",")


def prefix_trie(turns: DataFrame, fan_in: int = FAN_IN, slice_bits: int = SLICE_BITS) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ended (its end list; null if it has several slices), ends_sha256."""
    spark = turns.sparkSession
    digests = materialize(turn_digests(turns), "turn-digests")
    placed = numbered(digests)
    own, convs = rebuilt(placed)
    rows = paths(own, convs)
    drop(spark, digests, placed, convs)
    trie = merged_trie(rows, fan_in, slice_bits)
    nodes = trie.groupBy(*NODE).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in ("words", "p1", "p2")], F.count("slice").alias("slices"), F.max(F.when(F.col("slice").isNotNull(), F.col("ended"))).alias("ended")
    )
    children = trie.filter("depth > 0").select(*NODE, "p1", "p2").distinct().groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")})
    nodes = materialize(nodes, "nodes")
    streamed = streamed_digests(trie.filter("slice IS NOT NULL").join(nodes.filter("slices > 1").select(*NODE), NODE, "left_semi"))
    whole = nodes.join(rolled_up(nodes, rows), NODE).join(streamed, NODE, "left")
    found = whole.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.when(F.col("slices") == 0, F.array().cast("array<bigint>")).when(F.col("slices") == 1, F.col("ended")).alias("ended"),
        "streamed",
    )
    found = materialize(found.withColumn("ends_sha256", F.coalesce("streamed", F.sha2(ids_text(F.col("ended")), 256))).drop("streamed"), "trie")
    drop(spark, rows, trie, nodes)
    return found


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("ended")


#: crc32 of a text's bytes, one bit a step
CRC32_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], [((ascii(substr({s}, CAST(i // 8 AS INT) + 1, 1)) >> CAST(i % 8 AS INT)) & 1)::BIGINT FOR i IN range(8 * length({s}))]),
  lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)"""
SQL = r"""
WITH t AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM t),
c0 AS (SELECT conv_id, conv_id - conv_id % 20 AS family, CAST(conv_id AS VARCHAR) AS s, count(*) AS n FROM o GROUP BY conv_id),
c1 AS (SELECT *, CRC32 % 4 AS h FROM c0),
heads AS (SELECT c1.conv_id, o.pos AS depth, o.digest, o.words FROM c1 JOIN o ON o.conv_id = c1.family AND o.pos <= c1.h),
c AS (SELECT c1.*, coalesce(k.n, 0) AS taken FROM c1 LEFT JOIN (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id) k USING (conv_id)),
r AS (
  SELECT * FROM heads UNION ALL
  SELECT o.conv_id, o.pos - c.h + c.taken, o.digest, o.words FROM o JOIN c USING (conv_id) WHERE o.pos > c.h),
p AS (
  SELECT conv_id, depth, words, sha256(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p),
n0 AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM q GROUP BY node),
n AS (SELECT n0.*, coalesce(k.n, 0) AS n_children FROM n0 LEFT JOIN (SELECT parent, count(*) AS n FROM n0 WHERE depth > 0 GROUP BY parent) k ON k.parent = n0.node),
up AS (
  SELECT q.node, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM n JOIN q ON q.conv_id = n.conv_id AND q.depth <= n.depth GROUP BY q.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN up USING (node) LEFT JOIN n0 m ON m.node = n.parent
""".replace("CRC32", CRC32_SQL.format(s="s"))
