"""From task skeletons to user intents: prompt texts, replies, validity, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolgraph.functions.hashing import intent_id, skeleton_id
from toolgraph.functions.text import first_json
from toolgraph.operators.providers import ChatModel, replies

GENERATED_BY = "toolgraph"


def core_nodes(nodes: Column | str) -> Column:
    nodes = F.col(nodes) if isinstance(nodes, str) else nodes
    return F.filter(nodes, lambda n: n["role"] == "core")


def flow_text(edges: Column | str) -> Column:
    """One line a step in order, and a second one with the parameter where the edge has one."""
    edges = F.col(edges) if isinstance(edges, str) else edges
    ordered = F.array_sort(F.transform(edges, lambda e: F.struct(e["step"].alias("step"), e["from"].alias("from"), e["to"].alias("to"), e["dependency"]["parameter"].alias("parameter"))))
    has = lambda e: F.coalesce(e["parameter"] != "", F.lit(False))
    line = lambda e: F.concat(
        F.lit("Step "), e["step"].cast("string"), F.lit(": "), e["from"], F.lit(" -> "), e["to"],
        F.when(has(e), F.concat(F.lit("\n   fills "), e["parameter"])).otherwise(F.lit("")),
    )
    return F.array_join(F.transform(ordered, line), "\n")


def tool_texts(skeletons: DataFrame, tools: DataFrame) -> DataFrame:
    """(sample, tools_text): a JSON line for each core node that is registered with a name and a description, in node order."""
    named = skeletons.select("sample", F.posexplode(core_nodes("nodes")).alias("pos", "node")).select("sample", "pos", F.col("node.name").alias("name"))
    known = tools.filter("name <> '' AND description <> ''").select("name", F.to_json(F.struct("name", F.trim("description").alias("description"), "parameters")).alias("line"))
    lines = named.join(known, "name").groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("held"))
    return lines.select("sample", F.array_join(F.transform("held", lambda h: h["line"]), "\n").alias("tools_text"))


def prompts(skeletons: DataFrame, tools: DataFrame, template: str) -> DataFrame:
    """(sample, prompt) of the skeletons with a core node. ``template`` has ``{tools}`` and ``{flow}``."""
    texts = skeletons.filter(F.size(core_nodes("nodes")) > 0).join(tool_texts(skeletons, tools), "sample", "left")
    with_tools = F.replace(F.lit(template), F.lit("{tools}"), F.coalesce("tools_text", F.lit("")))
    return texts.select("sample", F.replace(with_tools, F.lit("{flow}"), flow_text("edges")).alias("prompt"))


def flat_scalars(state: Column) -> Column:
    """Whether every value of a map<string, variant> is a scalar that is not null; an empty map is."""
    kind = lambda v: F.schema_of_variant(v)
    return F.forall(F.map_values(state), lambda v: v.isNotNull() & ~F.is_variant_null(v) & ~kind(v).startswith("OBJECT") & ~kind(v).startswith("ARRAY"))


def grounded(query: Column, state: Column, chained: Column) -> Column:
    """How an initial state (map<string, variant>) fits its query: struct of ``said`` (each value is a scalar whose text stands in the query) and ``unchained`` (no key is a parameter that an earlier tool fills).

    An empty state is both. A null value, or one that is no scalar, is not said. A null query says nothing; null ``chained`` has no parameters.
    """
    text = lambda v: F.when(~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY|VOID)"), F.try_variant_get(v, "$", "string"))
    said = F.forall(F.map_values(state), lambda v: F.coalesce(F.contains(query, text(v)), F.lit(False)))
    unchained = ~F.arrays_overlap(F.map_keys(state), F.coalesce(chained, F.array().cast("array<string>")))
    return F.struct(said.alias("said"), F.coalesce(unchained, F.lit(True)).alias("unchained"))


def parsed_intents(answered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Intents, and the rejected rows (sample, reason). ``answered``: skeletons with ``reply``."""
    value = F.try_parse_json(first_json("reply"))
    state = lambda key: F.coalesce(F.try_variant_get(value, f"$.{key}", "map<string,variant>"), F.expr("CAST(map() AS map<string,variant>)"))
    rows = answered.withColumns({
        "query": F.try_variant_get(value, "$.query", "string"), "scenario": F.coalesce(F.try_variant_get(value, "$.scenario_summary", "string"), F.lit("")),
        "initial_state": state("initial_state"), "final_state": state("final_state"), "available_tools": F.transform("nodes", lambda n: n["name"]),
    })
    reason = F.when(value.isNull(), "no JSON in the reply").when(F.col("query").isNull(), "no query").when(~flat_scalars(F.col("initial_state")) | ~flat_scalars(F.col("final_state")), "a state is not flat")
    rows = rows.withColumn("reason", reason)
    meta = F.struct(skeleton_id("edges").alias("skeleton_id"), "scenario", "pattern", F.lit(GENERATED_BY).alias("generated_by"))
    good = rows.filter("reason IS NULL").select(
        intent_id("query", "available_tools", F.map_keys("initial_state"), F.map_keys("final_state")).alias("id"), "query", "initial_state", "final_state", "available_tools", meta.alias("meta")
    )
    return good, rows.filter("reason IS NOT NULL").select("sample", "reason")


def generate_intents(skeletons: DataFrame, tools: DataFrame, template: str, model: ChatModel) -> tuple[DataFrame, DataFrame]:
    """Intents of skeletons, and what was rejected. A bad reply rejects its row and never stops the batch."""
    asked = replies(prompts(skeletons, tools, template), "prompt", model).select("sample", "reply")
    return parsed_intents(skeletons.join(asked, "sample"))


def success_ratio(intents: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: asked, made, ratio in percent (0 if nothing was asked)."""
    both = intents.agg(F.count(F.lit(1)).alias("made")).crossJoin(rejected.agg(F.count(F.lit(1)).alias("lost")))  # one row each
    asked = F.col("made") + F.col("lost")
    return both.select(asked.alias("asked"), "made", F.coalesce(F.try_divide(F.col("made") * 100.0, asked), F.lit(0.0)).alias("ratio"))


def with_skeletons(intents: DataFrame, skeletons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Intents joined to the skeleton that their meta names (``skeletons``: with ``skeleton_id``), and those that have none."""
    return intents.join(skeletons, intents["meta.skeleton_id"] == skeletons["skeleton_id"]), intents.join(skeletons, intents["meta.skeleton_id"] == skeletons["skeleton_id"], "left_anti")


def tools_in_order(intents: DataFrame, tools: DataFrame) -> DataFrame:
    """(id, tools): definitions of each intent's available tools in their order; unknown names are dropped."""
    wanted = intents.select("id", F.posexplode("available_tools").alias("pos", "name"))
    found = wanted.join(tools, "name").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", F.to_json(F.struct("name", "description", "parameters")).alias("tool")))).alias("held"))
    return found.select("id", F.transform("held", lambda h: h["tool"]).alias("tools"))
