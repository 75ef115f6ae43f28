"""Rows of dirty JSON-lines files: broken lines are left out and counted, messages are repaired.

The text source plans byte ranges of each file, so one large file is read by many
tasks, and every line belongs to exactly one range. A line is parsed once; what is
no JSON object is a reject. In the same pass, metrics are observed: lines,
rejects, blank lines and repaired messages, so counting needs no second scan.

Defined results: blank lines are neither rows nor rejects. A row without
``conversations`` has an empty array. Null contents become empty, null tool calls
an empty array, and arguments JSON text (null: ``{}``), whatever type they had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from toolgraph.functions.text import valid_json
from toolgraph.operators.chat import repaired_messages

#: characters of a file that tell whether it is text
SNIFFED = 1024


def json_lines(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """(file, line, row variant) of the lines that hold a JSON object; ``observation`` gets the counts lines, blank and rejected when the result is first used."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("line"))
    parsed = lines.withColumn("row", F.try_parse_json(valid_json("line")))
    sound = F.coalesce(F.schema_of_variant("row").startswith("OBJECT"), F.lit(False))
    parsed = parsed.withColumn("__sound", sound)
    if observation:
        blank = F.col("line") == ""
        parsed = parsed.observe(observation, F.count(F.lit(1)).alias("lines"), F.count_if(blank).alias("blank"), F.count_if(~blank & ~F.col("__sound")).alias("rejected"))
    return parsed.filter("__sound").drop("__sound")


def repaired_rows(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """(file, line, messages): each sound row's conversation with its contents, tool calls and arguments repaired."""
    rows = json_lines(spark, path, observation)
    messages = F.coalesce(F.try_variant_get("row", "$.conversations", "array<variant>"), F.array().cast("array<variant>"))
    return rows.select("file", "line", repaired_messages(messages).alias("messages"))


def looks_like_text(head: bytes) -> bool:
    """Whether the beginning of a file is UTF-8 text: no NUL, and at most the last character cut."""
    if b"\x00" in head:
        return False
    for cut in range(4):
        try:
            head[: len(head) - cut].decode()
            return True
        except UnicodeDecodeError:
            continue
    return False
