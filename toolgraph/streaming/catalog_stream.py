"""Tool catalogues that arrive as files: a stream of sound tools, the first of each name within the watermark's memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolgraph.sources.catalog import tool_entries


def stream_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """(name, description, parameters) of JSON lines under ``folder``; state holds one key a name."""
    lines = spark.readStream.text(folder).select(F.lit(0).cast("long").alias("ord"), F.col("value").alias("line"))
    return tool_entries(lines).filter("sound").select("name", "description", F.to_json("parameters").alias("parameters")).dropDuplicates(["name"])
