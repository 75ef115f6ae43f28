"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: frees a query's shuffle files when the query ends
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a private temporary folder in local mode, an error on a cluster (executors do not see the driver's disk)."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="toolgraph-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on the session's Arrow batches have at most so many rows: batches of whole texts fit into small executors."""
    spark.conf.set(BATCH_ROWS, str(rows))


def materialize(df: DataFrame, name: str, batch_rows: int = 1000) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts lineage and survives lost executors.

    The shuffle files of the query that wrote it go with it, since nothing reads them any more. ``batch_rows``:
    rows of an Arrow batch meanwhile; whole texts and vectors make long batches large in both the JVM and Python.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    settings = {FREE_SHUFFLES: "true", BATCH_ROWS: str(batch_rows)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete scratch tables made by :func:`materialize` once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    base = shared_dir(spark).removeprefix("file://")
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            if base in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
