"""A cache of embeddings by content, so that a build embeds only texts that no earlier build has.

The key of a vector is the SHA-256 of the provider's name and the text. The cache
is a Parquet table partitioned by the key's first byte. A build finds what it
lacks by an anti join on (bucket, key), embeds each missing text once however
often it occurs, appends the new vectors by Spark's commit protocol, and joins
rows to vectors by key. A call that failed leaves nothing behind, so the next
build asks for it again. Two builds at once may both append a key; readers take
one, and :meth:`VectorCache.merge` rewrites the table with one vector a key.

Defined results: a null text counts as empty, as the provider sees it. Rows keep
all their columns, repeated rows included, and get ``v`` (null where the call
failed). An empty table gives an empty one and calls nobody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolgraph.operators.calls import Patience
from toolgraph.operators.providers import EMBED_BATCH, Embedder, embedded
from toolgraph.scratch import drop, materialize

SCHEMA = "bucket string, key string, v array<double>"


class VectorCache:
    """Vectors of one provider, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, provider: str):
        self.spark, self.path, self.provider = spark, path.rstrip("/"), provider

    def key(self, text: str) -> Column:
        return F.sha2(F.concat(F.lit(self.provider), F.lit("\u0000"), F.coalesce(F.col(text).cast("string"), F.lit(""))), 256)

    def exists(self, path: str | None = None) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def vectors(self) -> DataFrame:
        """(bucket, key, v), one row a key."""
        if not self.exists():
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).dropDuplicates(["bucket", "key"])

    def append(self, rows: DataFrame) -> None:
        rows.select("bucket", "key", "v").repartition("bucket").write.mode("append").partitionBy("bucket").parquet(self.path)

    def merge(self) -> None:
        """Rewrite the table with one vector a key: written beside it first, then the folders change places."""
        if not self.exists():
            return
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fresh, old = f"{self.path}.merged", f"{self.path}.replaced"
        self.vectors().repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(fresh)
        fs.delete(fs_path(old), True)
        fs.rename(fs_path(self.path), fs_path(old))
        fs.rename(fs_path(fresh), fs_path(self.path))
        fs.delete(fs_path(old), True)

    def embedded(self, rows: DataFrame, text: str, embed: Embedder, batch: int = EMBED_BATCH, patience: Patience = Patience()) -> DataFrame:
        """Adds ``v`` to ``rows``; the provider is called for texts that the cache lacks only."""
        columns = rows.columns
        keyed = rows.withColumn("__key", self.key(text))
        asked = keyed.select(F.col("__key").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).dropDuplicates(["key"])
        asked = asked.withColumn("bucket", F.substring("key", 1, 2))
        missing = materialize(asked.join(self.vectors().select("bucket", "key"), ["bucket", "key"], "left_anti"), "missing-texts")
        if not missing.isEmpty():
            new = embedded(missing, "text", embed, batch, patience)
            self.append(new.filter("v IS NOT NULL"))
            drop(self.spark, new)
        drop(self.spark, missing)
        known = self.vectors().select(F.col("key").alias("__key"), "v")
        return materialize(keyed.drop("v").join(known, "__key", "left").select(*[c for c in columns if c != "v"], "v"), "embedded")
