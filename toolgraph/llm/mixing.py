"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

1. Each source's share of the word budget is filled like water: every source
   gets ``level * weight`` words but never more than ``max_epochs`` times what it
   holds; what is cut off is reshared by weight, which one ``level`` for all
   uncapped sources expresses in closed form.
2. Within a source, documents stand in the order of a hash of doc_id, epoch
   after epoch, and each copy owns an interval of the source's token stream. A
   copy is taken when the middle of its interval lies within the target, so a
   source misses its target by half a document at most.
3. A source's weight runs linearly from a start to an end value over training
   time 0..1. Its integral is the cumulative demand; inverting it at the middle
   of a copy's interval gives the copy's training position. Range-sorting by
   position yields the training order.

Running sums are two-level: per (source, hash bucket) first, then inside a
bucket, so no task ever holds a whole source, even if it has a third of all rows.

Defined results: null text has size 0; sources are ordered by code point with
null last as a source of its own; sources without words have target 0; a
document of size 0 takes 0 words (its copies still have positions if its source
takes any). Rows repeated under one id are separate rows that follow each other
in the stream. A null doc_id hashes as the empty string; such rows are dealt into
buckets by their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolgraph.llm.rows import ids_tell_rows_apart, row_digest
from toolgraph.scratch import materialize

WEIGHTS = (3.0, 1.0, 2.0)
#: (weight at the start, weight at the end) of training, for sources by rank, repeating
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
BUDGET = 1.5
MAX_EPOCHS = 2
#: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def bucket() -> Column:
    """A text that sorts as (place, doc_id, size) do: the first three digits of the place, and rows of null ids, which share one place, by their size."""
    null_place = F.md5(F.lit(""))
    part = F.when(F.col("doc_id").isNull(), F.concat(F.lit("1"), F.lpad(F.col("size").cast("string"), 15, "0"))).when(F.col("place") < null_place, F.lit("0")).otherwise(F.lit("2"))
    return F.concat(F.substring("place", 1, 3), part)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row a source: source, rank, source_size, target. The windows run over sources, not documents."""
    everything = Window.orderBy(F.col("full"), F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("full"), F.col("rank")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.orderBy(F.col("full"), F.col("rank")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", cycled(weights, F.col("rank")))
        .withColumn("cap", F.col("source_size") * float(max_epochs))
        .withColumn("full", F.col("cap") / F.col("weight"))
    )
    # the level if this source and all that fill up later were uncapped
    levels = per_source.withColumn(
        "level",
        (F.sum("source_size").over(total) * F.lit(budget) - F.coalesce(F.sum("cap").over(everything), F.lit(0.0))) / F.sum("weight").over(after),
    )
    first_open = F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "rank", "level"))).over(total)
    return levels.withColumn("open", first_open).select(
        "source",
        "rank",
        "source_size",
        F.when(F.col("open").isNull() | (F.col("full") < F.col("open.full")), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("open.level") * F.col("weight")))
        .alias("target"),
    )


def position(share: Column, start: Column, end: Column) -> Column:
    """Training time at which a source whose weight runs from ``start`` to ``end`` has met ``share`` of its demand."""
    slope, area = end - start, (start + end) / 2.0
    root = F.sqrt(F.greatest(start * start + slope * area * share * 2.0, F.lit(0.0)))
    return F.when(slope == 0.0, share).otherwise((root - start) / slope)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    budget: float = BUDGET,
    max_epochs: int = MAX_EPOCHS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, repeats, positions (one a copy taken, 0..1), and the columns ``keys``."""
    sized = docs.select("doc_id", "source", *keys, words(F.col("text")).alias("size")).withColumn(
        "place", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    ).withColumn("bucket", bucket())
    # three branches read it: texts are read, and their words counted, once
    sized = materialize(sized.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))), "sized")
    targets = source_targets(sized, weights, budget, max_epochs).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("source_key"), "rank", "source_size", "target"
    )
    before = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sized.groupBy("source_key", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
        .join(targets, "source_key")
        .drop("bucket_size")
    )
    within = Window.partitionBy("source_key", "bucket").orderBy("place", "doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(buckets, ["source_key", "bucket"])
        .withColumn("start", F.col("bucket_start") + F.col("ahead"))
    )
    middle = lambda epoch: (F.col("source_size") * F.lit(epoch) + F.col("start")) * 2.0 + F.col("size")  # noqa: E731  twice the middle
    begin, end = cycled([a for a, _ in schedules], F.col("rank")), cycled([b for _, b in schedules], F.col("rank"))
    copies = F.array(*[
        F.when((F.col("target") > 0) & (middle(e) <= F.col("target") * 2.0), position(middle(e) / (F.col("target") * 2.0), begin, end))
        for e in range(max_epochs)
    ])
    return (
        placed.withColumn("positions", F.filter(copies, lambda p: p.isNotNull()))
        .withColumn("repeats", F.size("positions"))
        .withColumn("taken", F.col("repeats") * F.col("size"))
        .select("doc_id", "size", "source_size", "target", "taken", "repeats", "positions", "place", *keys)
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Range-sorts rows by their first position; rows that are not taken follow, spread by their hash."""
    spread = F.conv(F.substring("place", 1, 12), 16, 10).cast("double") + 2.0
    key = F.coalesce(F.try_element_at("positions", F.lit(1)), spread)
    return mixed.withColumn("order_key", key).repartitionByRange("order_key", "place").sortWithinPartitions("order_key", "place").drop("order_key", "place")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as training reads them: each taken copy is a row with all its columns, in training order."""
    if ids_tell_rows_apart(docs.select("doc_id")):
        taken = mix(docs, **options).filter("repeats > 0").select(F.col("doc_id").alias("__id"), "positions")
        rows = docs.join(taken, docs["doc_id"] == taken["__id"]).withColumn("__at", F.explode("positions"))
    else:
        # equal rows have a place each but are one another's equals: all their places go to one of them
        keyed = docs.withColumn("__row", row_digest(docs))
        taken = mix(keyed, **options, keys=["__row"]).filter("repeats > 0").select("__row", F.explode("positions").alias("__at"))
        rows = keyed.dropDuplicates(["__row"]).join(taken, "__row")
    return rows.repartitionByRange("__at", "doc_id").sortWithinPartitions("__at", "doc_id").select(*[F.col(c) for c in docs.columns])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return in_training_order(mix(docs)).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rnk FROM s0),
s2 AS (
  SELECT *, CASE rnk % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap FROM s1),
s3 AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
            / sum(weight) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s2),
s4 AS (
  SELECT source, source_size,
         CASE WHEN cap / weight < lvl.f OR lvl.f IS NULL THEN cap ELSE least(cap, lvl.level * weight) END AS target
  FROM s3, (SELECT min(cap / weight) AS f, arg_min(level, (cap / weight, rnk)) AS level FROM s3 WHERE level <= cap / weight) AS lvl),
placed AS (
  SELECT z.doc_id, z.size, s.source_size, s.target,
         coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.place, z.doc_id, z.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS start
  FROM sized z JOIN s4 s ON z.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (CAST(target > 0 AND start * 2 + size <= target * 2 AS INT)
                  + CAST(target > 0 AND (source_size + start) * 2 + size <= target * 2 AS INT)) AS BIGINT) AS taken
FROM placed
"""
