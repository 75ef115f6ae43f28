"""Telling rows apart where doc_id does not: ids that are null or repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ids_tell_rows_apart(docs: DataFrame) -> bool:
    """Whether no doc_id is null or stands on two rows."""
    return docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").isEmpty()


def row_digest(docs: DataFrame) -> Column:
    """Equal for rows that are equal in all columns."""
    return F.sha2(F.to_json(F.struct(*[docs[c] for c in docs.columns]), {"ignoreNullFields": "false"}), 256)
