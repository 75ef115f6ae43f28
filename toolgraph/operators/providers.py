"""Model calls as pluggable providers: embedding, edge verification, categories. Calls run once, inside tasks, and are written down.

A provider is a picklable callable. What it returned is materialised before
anything else uses it, so a retry or a second action never calls it again. A task
has several calls in flight (:mod:`toolgraph.operators.calls`); embeddings of
earlier builds can be kept (:mod:`toolgraph.sources.vector_cache`).
"""

from __future__ import annotations

import hashlib
from itertools import chain
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolgraph.functions.text import first_json, title
from toolgraph.operators.calls import Patience, in_flight
from toolgraph.scratch import materialize

EMBED_BATCH = 64
GENERAL = "general"
#: fixed values: the category pool to begin with
CATEGORY_POOL = [
    "Finance", "Development", "Communication", "Media", "Utilities", "Health", "Data", "Science",
    "Business", "Social", "Shopping", "Education", "Travel", "Security", "Location", "Lifestyle",
]

Embedder = Callable[[list[str]], list[list[float]]]
ChatModel = Callable[[list[str]], list[str]]


def stub_embedder(dim: int = 16) -> Embedder:
    """Deterministic vectors of up to 16 numbers, the bytes of the text's md5, for tests."""

    def embed(texts: list[str]) -> list[list[float]]:
        return [(np.frombuffer(hashlib.md5(t.encode()).digest()[:dim], np.uint8) / 127.5 - 1).tolist() for t in texts]

    return embed


def asked_in_batches(call: Callable[[list[str]], list], texts: list[str], batch: int, patience: Patience) -> list:
    """One result a text, ``batch`` texts a call; a call that fails, or answers with another number of results, gives nulls for its batch."""
    groups = [texts[at : at + batch] for at in range(0, len(texts), batch)]

    def sized(group: list[str]) -> list:
        found = list(call(group))
        if len(found) != len(group):
            raise ValueError("not one result a text")
        return found

    return list(chain.from_iterable(found if found is not None else [None] * len(group) for group, found in zip(groups, in_flight(sized, groups, patience), strict=True)))


def embedded(rows: DataFrame, text: str, embed: Embedder, batch: int = EMBED_BATCH, patience: Patience = Patience()) -> DataFrame:
    """Adds ``v``: a vector for each text, ``batch`` texts a call, several calls at once. A call that keeps failing gives nulls for its whole batch."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, v array<double>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors = asked_in_batches(lambda texts: [list(map(float, v)) for v in embed(texts)], frame[text].fillna("").tolist(), batch, patience)
            yield frame.assign(v=vectors)

    return materialize(rows.mapInPandas(run, schema), "embedded")


def embedded_count(rows: DataFrame) -> DataFrame:
    """One row: texts, and how many of them have a vector."""
    return rows.agg(F.count(F.lit(1)).alias("texts"), F.count("v").alias("embedded"))


def replies(rows: DataFrame, prompt: str, model: ChatModel, batch: int = 1, patience: Patience = Patience()) -> DataFrame:
    """Adds ``reply``: the model's text for each prompt, null where the call kept failing or took too long. ``patience.window`` calls of ``batch`` prompts are in flight in a task."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, reply string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(reply=asked_in_batches(model, frame[prompt].fillna("").tolist(), batch, patience))

    return materialize(rows.mapInPandas(run, schema), "replies")


def verdict(reply: Column | str) -> Column:
    """Whether a verification reply's first JSON says ``valid``; false on anything else."""
    return F.coalesce(F.get_json_object(first_json(reply), "$.valid") == "true", F.lit(False))


def verified(candidates: DataFrame, prompt: str, model: ChatModel) -> DataFrame:
    """Candidates routed ``direct``, and those routed ``verify`` that the model accepts."""
    direct = candidates.filter("route = 'direct'")
    asked = replies(materialize(candidates.filter("route = 'verify'"), "to-verify"), prompt, model)
    return direct.unionByName(asked.filter(verdict("reply")).drop("reply"))


def verification_prompts(candidates: DataFrame, tools: DataFrame) -> DataFrame:
    """Adds ``prompt``: producer, consumer and parameter of a candidate with their descriptions. ``tools``: (name, description, parameters as a struct or JSON text)."""
    parameters = F.col("parameters") if tools.schema["parameters"].dataType.typeName() == "string" else F.to_json("parameters")
    known = tools.select("name", "description", F.from_json(parameters, "struct<properties:map<string,string>>")["properties"].alias("properties"))
    producers = known.select(F.col("name").alias("producer"), F.col("description").alias("__p"))
    consumers = known.select(F.col("name").alias("consumer"), F.col("properties").alias("__properties"))
    about = F.coalesce(F.get_json_object(F.try_element_at("__properties", F.col("param").cast("string")), "$.description"), F.lit(""))
    text = F.concat(
        F.lit("Can what the first tool returns be used as the given input of the second? Answer with a JSON object whose only field, valid, is true or false.\nFirst tool: "), F.col("producer").cast("string"),
        F.lit(" ("), F.coalesce("__p", F.lit("")), F.lit(")\nSecond tool: "), F.col("consumer").cast("string"), F.lit("\nInput: "), F.col("param").cast("string"), F.lit(" ("), about, F.lit(")"),
    )
    return candidates.join(producers, "producer", "left").join(consumers, "consumer", "left").select(*candidates.columns, text.alias("prompt"))


def categorised(tools: DataFrame, prompt: str, model: ChatModel) -> DataFrame:
    """Tools whose category is still general get the model's, stripped and title-cased; general again if it gave none."""
    asked = replies(tools.filter(F.col("category") == GENERAL), prompt, model)
    given = title(F.get_json_object(first_json("reply"), "$.category"))
    named = asked.withColumn("category", F.when(F.coalesce(given, F.lit("")) != "", given).otherwise(F.lit(GENERAL))).drop("reply")
    return tools.filter(F.coalesce(F.col("category") != GENERAL, F.lit(True))).unionByName(named)


def categorised_in_rounds(tools: DataFrame, model: ChatModel, rounds: int = 8) -> DataFrame:
    """:func:`categorised`, a share of the tools a round: each prompt names the categories in use so far, so that later rounds take up what earlier ones added.

    Tools that a round's model call left general are not asked again. The list of categories in a prompt is the pool.
    """
    columns = tools.columns
    shown = F.concat(F.lit("\nTool: "), "name", F.lit("\nWhat it does: "), F.coalesce("description", F.lit("")), F.lit("\nInputs: "), F.coalesce(F.col("parameters") if tools.schema["parameters"].dataType.typeName() == "string" else F.to_json("parameters"), F.lit("")))
    left = tools.withColumn("__round", F.when(F.col("category") == GENERAL, F.pmod(F.xxhash64("name"), F.lit(rounds))).otherwise(-1))
    done = left.filter("__round = -1 OR category IS NULL").select(*columns)
    for k in range(rounds):
        own = left.filter(F.col("__round") == k)
        pool = category_pool(done).filter(F.col("category") != GENERAL).agg(F.array_join(F.array_sort(F.collect_set("category")), ", ").alias("__pool"))  # one row
        asked = own.crossJoin(pool).withColumn("prompt", F.concat(F.lit("Categories: "), "__pool", shown))
        done = materialize(done.unionByName(categorised(asked, "prompt", model).select(*columns)), "categorised")
    return done


def refined(tools: DataFrame, model: ChatModel) -> DataFrame:
    """:func:`consolidated` by one call of the model, which sees all categories in use and returns a JSON object from old to new ones.

    Without a category, a reply, or an object in it, the tools stay as they are.
    """
    used = tools.select("category").filter("category <> ''").distinct().agg(F.to_json(F.array_sort(F.collect_set("category"))).alias("prompt"))
    asked = replies(used.filter("prompt <> '[]'"), "prompt", model)
    mapping = asked.select(F.explode(F.from_json(first_json("reply"), "map<string,string>")).alias("raw", "master")).filter("master IS NOT NULL")
    return consolidated(tools, mapping)


def category_pool(tools: DataFrame) -> DataFrame:
    """(category): the fixed pool and every category in use, without null and empty ones."""
    fixed = tools.sparkSession.createDataFrame([(c,) for c in CATEGORY_POOL], "category string")
    return fixed.union(tools.select("category").filter("category IS NOT NULL AND category <> ''")).distinct()


def consolidated(tools: DataFrame, mapping: DataFrame) -> DataFrame:
    """Categories replaced by ``mapping`` (raw, master); what it lacks stays."""
    return tools.join(mapping, tools["category"] == mapping["raw"], "left").withColumn("category", F.coalesce("master", "category")).drop("raw", "master")
