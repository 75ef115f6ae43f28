"""Benchmark scores: positional tables, percent ranks, report lines, accuracy, resumption."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolgraph.functions.hashing import uniform
from toolgraph.functions.text import percent
from toolgraph.scratch import materialize

CONTEXT_LIMIT = 32000
#: fixed values: of each category its score file and the column that ranks it
CATEGORIES = {
    "multi_turn": ("data_multi_turn.csv", "Multi Turn Overall Acc"),
    "overall": ("data_overall.csv", "Overall Acc"),
    "live": ("data_live.csv", "Live Overall Acc"),
    "non_live": ("data_non_live.csv", "Non Live Overall Acc"),
    "agentic": ("data_agentic.csv", "Agentic Overall Acc"),
    "format": ("data_format_sensitivity.csv", "Format Sensitivity Overall Acc"),
}
#: fixed values: the benchmark's subsets
SUBSETS = [
    "simple", "parallel", "multiple", "parallel_multiple", "java", "javascript", "miss_func", "chatable",
    "multi_turn_base", "multi_turn_miss_func", "multi_turn_miss_param", "multi_turn_long_context", "long_context",
]


def category(name: str) -> tuple[str, str]:
    """File and rank column of a category, in any case."""
    if name.lower() not in CATEGORIES:
        raise ValueError(f"unknown category {name!r}; known: {', '.join(CATEGORIES)}")
    return CATEGORIES[name.lower()]


def chosen_subsets(text: str | None) -> list[str]:
    """A comma list, trimmed; all subsets if it is blank."""
    return [s.strip() for s in text.split(",") if s.strip()] if text and text.strip() else SUBSETS


def chosen_limit(text: str | None) -> int | None:
    """A row limit from an environment text; none if it is blank or not above 0."""
    return int(text) if text and text.strip() and int(text) > 0 else None


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds 1..n in the given order: a range sort, and an offset for each of its partitions, so that no task holds all rows."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the partition
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__place", place), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))  # one row a partition
    return placed.join(F.broadcast(sizes), "__part").withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__part", "__place", "__n", "__before")


def ranked(scores: DataFrame, column: str, *ties: str) -> DataFrame:
    """Sorted by the percent in ``column``, largest first, then by ``ties``; ``Rank``, if there is one, becomes 1..n as text.

    Without the column the rows stay as they are.
    """
    if column not in scores.columns:
        return scores
    order = [percent(F.col(f"`{column}`")).desc(), *[F.col(t) for t in ties]]
    if "Rank" in scores.columns:
        columns = scores.columns
        scores = numbered(scores, order, "__rank").withColumn("Rank", F.col("__rank").cast("string")).select(*columns)
    return scores.orderBy(*order)


def score_tables(spark: SparkSession, root: str, file: str) -> DataFrame:
    """``<root>/<experiment>/score/<file>`` of all experiments under one header: that of the first; columns go by position.

    Adds ``Experiment`` and ``row_ord`` in front. Empty and missing files are skipped; short rows have nulls at the end,
    cells beyond the header are left out, and quoted cells may hold line breaks.
    """
    files = spark.read.format("binaryFile").load(f"{root}/*/score/{file}").select(F.regexp_extract("path", r"/([^/]+)/score/[^/]+$", 1).alias("Experiment"), F.decode("content", "UTF-8").alias("text"))
    kind = "Experiment string, row_ord int, cells array<string>"

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(e, k, cells) for e, text in zip(frame["Experiment"], frame["text"], strict=True) for k, cells in enumerate(csv.reader(io.StringIO(text, newline=""))) if cells]
            yield pd.DataFrame(found, columns=["Experiment", "row_ord", "cells"])

    cells = files.mapInPandas(rows, kind)
    first = cells.filter("row_ord = 0").orderBy("Experiment").select("cells").first()
    if first is None:
        return spark.createDataFrame([], "Experiment string, row_ord int")
    taken = ["Experiment", "row_ord"]
    for k, name in enumerate(first["cells"]):
        taken.append(name if name and name not in taken else f"{name}_{k}")  # an empty or repeated name keeps its place under a name of its own
    return cells.filter("row_ord > 0").select("Experiment", "row_ord", *[F.try_element_at("cells", F.lit(k + 1)).alias(h) for k, h in enumerate(taken[2:])])


def normalised(score: Column) -> Column:
    """Shares become percents."""
    return F.when(score <= 1, score * 100).otherwise(score)


def report_lines(reports: DataFrame, subset: Column) -> DataFrame:
    """(model_name, name, num, score, line) of the subsets called ``subset`` in nested reports (metrics of categories of subsets)."""
    flat = reports.select("model_name", subset.alias("subset"), F.explode("metrics.categories").alias("categories")).select("model_name", "subset", F.explode("categories.subsets").alias("subsets"))
    flat = flat.select("model_name", "subset", F.explode("subsets").alias("s")).filter("s.name = subset")
    value = normalised(F.col("s.score"))
    return flat.select("model_name", "s.name", "s.num", value.alias("score"), F.format_string("Score: %.4f (%.2f%%)", "s.score", value).alias("line"))


def accuracy(results: DataFrame, passed: str, key: str) -> DataFrame:
    """One row: total, passed, accuracy in percent (0 for none), failed keys in order. A null verdict is a failure."""
    ok = F.coalesce(F.col(passed), F.lit(False))
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.array_sort(F.collect_list(F.when(~ok, F.col(key)))).alias("failed")
    ).withColumn("accuracy", F.coalesce(F.try_divide(F.col("passed") * 100.0, F.col("total")), F.lit(0.0)))


def remaining(subsets: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is not on the done list (same column name, trimmed, blanks dropped)."""
    finished = done.select(F.trim(F.col(key).cast("string")).alias("__done")).filter("__done <> ''").distinct()
    return subsets.join(finished, F.trim(F.col(key).cast("string")) == F.col("__done"), "left_anti")


def context_use(tokens: Column, limit: int = CONTEXT_LIMIT) -> Column:
    return F.struct((tokens > limit).alias("over"), (F.lit(limit) - tokens).alias("left"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def limited(rows: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first ``limit`` rows in the given order; all of them if there is no limit, or none above 0."""
    return rows.orderBy(*order).limit(limit) if limit and limit > 0 else rows


def subsample(rows: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """About that share of the rows, drawn by a hash of ``key``: the same rows in every run."""
    return rows.filter(uniform(seed, key) <= share)


def multi_turn_only(rows: DataFrame, wanted: bool = True) -> DataFrame:
    """Rows whose ``multi_turn`` is true; all of them if that is not wanted or there is no such column."""
    return rows.filter(F.coalesce(F.col("multi_turn").cast("boolean"), F.lit(False))) if wanted and "multi_turn" in rows.columns else rows
