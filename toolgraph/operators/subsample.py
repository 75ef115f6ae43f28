"""Exactly n rows, drawn by a hash: the n least of (md5 of the key, md5 of the row).

The rank of the n-th hash is found from histograms of its leading digits: the
bin in which the count passes n is counted again by its next digits, until few
rows are left or the digits end. A histogram has at most 16 ** ``DIGITS`` rows, so
no task and no driver ever sees the rows, and nothing is sorted globally.

Defined results: with fewer than n rows all stay; n below 1 keeps none. A null
key is the empty text. Rows that are equal in all columns are interchangeable.
The result does not depend on partitions or order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: hexadecimal digits of the hash that one histogram counts
DIGITS = 3
#: rows of the last bin that are ordered rather than counted again
ORDERED = 10_000


def row_hash(rows: DataFrame, key: str | Column) -> Column:
    """64 hexadecimal digits: the key's, then the row's."""
    key = F.col(key) if isinstance(key, str) else key
    whole = F.to_json(F.struct(*[rows[c] for c in rows.columns]), {"ignoreNullFields": "false"})
    return F.concat(F.md5(F.coalesce(key.cast("string"), F.lit(""))), F.md5(whole))


def boundary(hashed: DataFrame, column: str, n: int) -> tuple[str, int]:
    """The leading digits of the bin where the n-th least hash lies, and how many of its rows are among the n least."""
    prefix, before = "", 0
    while len(prefix) < 64:
        inside = hashed.filter(F.col(column).startswith(prefix)) if prefix else hashed
        bins = inside.groupBy(F.substring(column, 1, len(prefix) + DIGITS).alias("bin")).count()
        upto = F.sum("count").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))  # over at most 16 ** DIGITS rows
        found = bins.withColumn("upto", upto + before).filter(F.col("upto") >= n).orderBy("bin").first()
        prefix, before = found["bin"], found["upto"] - found["count"]
        if found["count"] <= ORDERED:
            break
    return prefix, n - before


def exactly(rows: DataFrame, key: str | Column, n: int) -> DataFrame:
    """``n`` of the rows with all their columns."""
    if n < 1:
        return rows.limit(0)
    if rows.count() <= n:
        return rows
    columns = rows.columns
    hashed = rows.withColumn("__hash", row_hash(rows, key))
    prefix, rest = boundary(hashed, "__hash", n)
    at = F.substring("__hash", 1, len(prefix))
    last = hashed.filter(at == prefix)
    last = last.limit(rest) if len(prefix) >= 64 else last.orderBy("__hash").limit(rest)
    return hashed.filter(at < prefix).unionAll(last).select(*columns)
