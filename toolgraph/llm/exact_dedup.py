"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

Every document gets a digest of its normalised text. Each input partition is a
*run*: its entries, one a digest (level 0). The runs are cut into the same ranges
of hashed digests once, so that a range's pieces of all runs lie in one task.
From then on nothing moves: round by round, each range merges ``fan_in``
neighbouring runs (three rounds of a binomial tree at once) by an aggregate over
entries sorted by (run, digest), in which equal ones keep the largest identifier
and the summed count, until a single run is left; and the winners travel the same
tree downwards by sort-merge joins over the same ranges. Entries are equal only if
SHA-256, length and an independent second hash of the text agree, at every level.
A text that a third of all rows share has one entry a run and is never one task's
work. Text is read once and never shuffled; only digests are.

Defined results: null text counts as empty; all empty texts are one group. A
null doc_id never wins over a real one; a group of only null ids keeps null,
and its rows have kept = true. Rows repeated with the same doc_id and text are
counted in group_size each, and all rows that carry the winning id are kept.
An empty table gives an empty result. Other columns are ignored by
:func:`digest_groups` and passed on by :func:`drop_exact_copies`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolgraph.scratch import drop, materialize

FAN_IN = 8
#: texts are equal when all of these are
KEY = ["digest", "n_bytes", "proof"]
#: whether a join's sides, dealt by some of its keys, are dealt anew by all of them
JOIN_IN_PLACE = "spark.sql.requireAllClusterKeysForCoPartition"


def normalised(text: Column) -> Column:
    """Lower-cases A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run, digest, n_bytes, proof): the digests of each input partition."""
    text = normalised(F.col("text"))
    return docs.select(
        F.col("doc_id"), F.spark_partition_id().alias("run"), F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("proof")
    )


def merge_round(level: DataFrame, fan_in: int) -> DataFrame:
    """One round: ``fan_in`` neighbouring sorted runs become one; equal digests keep the winning id and the summed count."""
    winner = F.max(F.struct(F.col("keep_id").isNotNull().alias("known"), "keep_id")).alias("winner")  # a struct's maximum is merged from sorted rows
    return (
        level.select((F.col("run") / fan_in).cast("int").alias("run"), *KEY, "keep_id", "group_size")
        .groupBy("run", *KEY)
        .agg(winner, F.sum("group_size").alias("group_size"))
        .select("run", *KEY, F.col("winner.keep_id").alias("keep_id"), "group_size")
    )


def hand_down(level: DataFrame, parents: DataFrame, fan_in: int) -> DataFrame:
    """Give the entries of each run the winner that the run above it holds."""
    parents = parents.withColumnRenamed("run", "parent")
    return (
        level.select("run", *KEY, (F.col("run") / fan_in).cast("int").alias("parent"))
        .join(parents, ["parent", *KEY])
        .select("run", *KEY, "keep_id", "group_size")
    )


def run_winners(runs: DataFrame, width: int, fan_in: int = FAN_IN) -> DataFrame:
    """(run, key, keep_id, group_size): what the merge of all ``width`` runs holds for each entry of each run."""
    levels = [runs.repartition("digest")]
    while width > 1:
        levels.append(merge_round(levels[-1], fan_in))
        width = -(-width // fan_in)
    winners = levels[-1]
    for level in reversed(levels[:-1]):
        winners = hand_down(level, winners, fan_in)
    return winners


def digest_groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row a document: doc_id, keep_id (largest doc_id of equal texts), group_size, kept, text_sha256."""
    spark = docs.sparkSession
    digests = materialize(digest_runs(docs), "digests")
    runs = materialize(merge_round(digests.select("run", *KEY, F.col("doc_id").alias("keep_id"), F.lit(1).alias("group_size")), 1), "runs")
    width = (runs.agg(F.max("run")).first()[0] or 0) + 1
    before = spark.conf.get(JOIN_IN_PLACE)
    try:
        spark.conf.set(JOIN_IN_PLACE, "false")
        winners = materialize(run_winners(runs, width, fan_in), "winners")
    finally:
        spark.conf.set(JOIN_IN_PLACE, before)
    drop(spark, runs)
    return digests.join(winners, ["run", *KEY]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One document of each group, with all its columns: of the winning id's rows any one, if several hold the text."""
    kept = digest_groups(docs, fan_in).filter("kept").groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).count()
    kept = materialize(kept, "kept")
    keyed = docs.withColumn("__own_sha", F.sha2(normalised(docs["text"]), 256))

    def rows(winners: DataFrame) -> DataFrame:
        return keyed.join(winners, keyed["doc_id"].eqNullSafe(winners["__id"]) & (keyed["__own_sha"] == winners["__sha"]), "left_semi")

    stay = rows(kept.filter("count = 1"))
    repeated = kept.filter("count > 1")
    if not repeated.isEmpty():
        stay = stay.union(rows(repeated).dropDuplicates(["doc_id", "__own_sha"]))
    return stay.drop("__own_sha")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = """
WITH d AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""
