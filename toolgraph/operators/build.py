"""The whole graph build: categories, vectors, similarity join, verification, edges, pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolgraph.operators import graph, providers, similarity
from toolgraph.operators.providers import ChatModel, Embedder
from toolgraph.scratch import materialize
from toolgraph.sources.catalog import consumer_texts, producer_texts
from toolgraph.sources.vector_cache import VectorCache


def build_graph(
    tools: DataFrame, embed: Embedder, model: ChatModel | None = None, recall: float = similarity.RECALL, auto: float = similarity.AUTO, top_k: int = similarity.TOP_K, verify: bool = True, prune_isolates: bool = True,
    category_rounds: int = 8, cache: VectorCache | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a catalogue: (name, description, category, parameters) and keyed multi-edges.

    ``tools`` is a table of :func:`toolgraph.sources.catalog.catalog`. Candidates from ``auto`` on are edges; those below
    are verified by ``model``, dropped without one, and taken unseen if ``verify`` is off. A tool or parameter whose
    embedding call failed has no candidates. Without tools both are empty; without any vector of a producer or of a
    parameter all nodes stay, unpruned, and there are no edges. With a ``cache``, only texts that no earlier build embedded
    are sent to the provider.
    """
    nodes = tools.select("name", "description", "category", "parameters")
    if model is not None:
        nodes = materialize(providers.refined(providers.categorised_in_rounds(nodes, model, category_rounds), model), "nodes")
    vectors = cache.embedded if cache else providers.embedded
    producers = vectors(producer_texts(nodes), "text", embed).select("producer", "v")
    consumers = vectors(consumer_texts(nodes), "text", embed).select("consumer", "param", "v")
    without = producers.filter("v IS NOT NULL").isEmpty() or consumers.filter("v IS NOT NULL").isEmpty()
    found = similarity.without_self(similarity.top_matches(producers, consumers, recall, top_k))
    routed = materialize(found.withColumn("route", similarity.route(F.col("score"), auto, verify, model is not None)).filter("route <> 'drop'"), "candidates")
    taken = routed
    if model is not None and verify:
        taken = providers.verified(providers.verification_prompts(routed, nodes), "prompt", model)
    edges = materialize(similarity.graph_edges(taken), "edges")
    return (graph.prune(nodes, edges) if prune_isolates and not without else nodes), edges
