"""A ledger of finished rows, by micro-batch, so that a job that stops goes on where it was.

Each batch writes its rows into a folder of its own, named by the job and the
batch id, replacing what an earlier try of the same batch left. A batch that is
replayed after a failure therefore appends nothing twice. A job's name must go
with its checkpoint: a new checkpoint counts batches from zero again.

Defined results: no ledger yet means nothing is finished; a null key is never
finished; repeated rows of a batch are kept as they come.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Ledger:
    """Rows finished by ``job``, under ``path``; ``schema`` is that of the rows."""

    def __init__(self, spark: SparkSession, path: str, job: str, schema: str):
        self.spark, self.job, self.schema = spark, job, T.StructType.fromDDL(schema)
        self.path = f"{path.rstrip('/')}/job={job}"

    def batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def exists(self) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.mode("overwrite").parquet(self.batch_path(batch_id))

    def sink(self, work: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: ``work`` on a batch's rows, written under its id."""

        def write(rows: DataFrame, batch_id: int) -> None:
            self.write(work(rows), batch_id)

        return write

    def rows(self) -> DataFrame:
        """All rows finished so far."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self.path)

    def remaining(self, rows: DataFrame, key: str) -> DataFrame:
        """Those of ``rows`` whose key no finished row has; a static table, or a stream against what is finished now."""
        done = self.rows().select(F.col(key).alias("__done")).filter("__done IS NOT NULL").distinct()
        return rows.join(done, F.col(key) == F.col("__done"), "left_anti")
