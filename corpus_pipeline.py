"""From raw documents to encoded training rows, in five stages.

Each stage reads what the one before it wrote. All but the last return the
columns of ``documents``. Rows that the language models reject go; of equal
texts the row with the largest doc_id stays; of near duplicates the one with
the smallest; the mix repeats or leaves out documents to meet its targets, and
puts them in training order; the last stage returns ids and their round trip.
No stage can be written as one SQL statement over the whole pipeline, since
language models and samples are not SQL; tests hold it against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from toolgraph.llm import bpe, exact_dedup, language_id, minhash, mixing
from toolgraph.scratch import materialize, short_batches


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no language model accepts (no letters, or cross-entropy far above its language's)."""
    short_batches(spark)
    return language_id.keep_known(docs, language_id.train(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark, 2500)  # the encoder looks each chunk of a batch up once
    return bpe.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
