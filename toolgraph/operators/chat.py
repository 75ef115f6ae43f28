"""Conversations: memory to chat rows, role-tagged turns, repair of dirty rows, alignment, lengths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolgraph.functions.text import chat_role, content_text, is_control

CALL = "array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>"
BLOCKS = "array<struct<type:string,text:string,id:string,name:string,input:string,output:string>>"


def chat_rows(messages: DataFrame) -> DataFrame:
    """(conv_id, messages): chat rows of an agent's memory, in turn order.

    ``messages``: (conv_id, turn, name, role, blocks). What a row becomes depends on its *name*, except that a system
    row with tool results gives one ``tool`` row a result. A user's stop words and rows of other names are dropped;
    empty text is null; ``tool_calls`` is null when there are none. Null conv_ids are kept as one conversation.
    """
    text = content_text("blocks")
    results = F.filter("blocks", lambda b: b["type"] == "tool_result")
    calls = F.transform(
        F.filter("blocks", lambda b: b["type"] == "tool_use"),
        lambda b: F.struct(b["id"].alias("id"), F.lit("function").alias("type"), F.struct(b["name"].alias("name"), F.coalesce(b["input"], F.lit("{}")).alias("arguments")).alias("function")),
    ).cast(CALL)
    none = F.lit(None).cast("string")
    row = lambda role, content, name=none, call=none, tool_calls=F.lit(None).cast(CALL): F.struct(
        F.lit(role).alias("role"), content.alias("content"), name.alias("name"), call.alias("tool_call_id"), tool_calls.alias("tool_calls")
    )
    shown = F.when(text != "", text)
    made = (
        F.when((F.col("role") == "system") & (F.size(results) > 0), F.transform(results, lambda b: row("tool", b["output"], b["name"], b["id"])))
        .when(F.col("role") == "system", F.array(row("system", shown)))
        .when((F.col("name") == "user") & is_control(text), F.array().cast("array<struct<role:string,content:string,name:string,tool_call_id:string,tool_calls:" + CALL + ">>"))
        .when(F.col("name") == "user", F.array(row("user", shown)))
        .when(F.col("name") == "assistant", F.array(row("assistant", shown, tool_calls=F.when(F.size(calls) > 0, calls))))
    )
    rows = messages.select("conv_id", "turn", F.posexplode(made).alias("pos", "message"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "pos", F.col("message").alias("message")))).alias("held")).select("conv_id", F.transform("held", lambda h: h["message"]).alias("messages"))


def tagged_to_chat(conversations: Column | str) -> Column:
    """array<struct<from, value>> to array<struct<role, content>>."""
    turns = F.col(conversations) if isinstance(conversations, str) else conversations
    return F.transform(turns, lambda t: F.struct(chat_role(t["from"]).alias("role"), t["value"].alias("content")))


def function_tools(tools: DataFrame) -> DataFrame:
    """(type, function): name, description and parameters in the function envelope; every other field goes. Nameless tools are skipped, the last of a name wins."""
    last = Window.partitionBy("name").orderBy(F.col("ord").desc())
    picked = tools.filter("name IS NOT NULL AND name <> ''").withColumn("nth", F.row_number().over(last)).filter("nth = 1")
    return picked.orderBy("ord").select(
        F.lit("function").alias("type"),
        F.struct("name", F.coalesce("description", F.lit("")).alias("description"), F.struct(F.lit("object").alias("type"), F.col("parameters.properties").alias("properties"), F.coalesce("parameters.required", F.array().cast("array<string>")).alias("required")).alias("parameters")).alias("function"),
    )


def repaired_messages(messages: Column) -> Column:
    """Messages whose null content is empty text, whose null tool calls are an empty array, and whose arguments are JSON text (null: ``{}``).

    ``messages``: a variant array of chat rows with ``arguments`` of any type. The result has them as strings.
    """
    kind = "array<struct<role:string,content:string,tool_calls:array<struct<function:struct<name:string,arguments:variant>>>>>"
    argument = lambda v: F.when(v.isNull() | F.is_variant_null(v), F.lit("{}")).when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string")).otherwise(F.to_json(v))
    call = lambda c: F.struct(F.struct(c["function"]["name"].alias("name"), argument(c["function"]["arguments"]).alias("arguments")).alias("function"))
    return F.transform(
        messages.cast(kind),
        lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"), F.coalesce(F.transform(m["tool_calls"], call), F.array()).alias("tool_calls")),
    )


def aligned_turns(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, pos, question, truth): questions with the answer at the same position; an empty array where there is none, or no answers at all.

    ``questions``: (id, question array), ``answers``: (id, truth array of arrays). ``found`` tells whether the id has answers.
    """
    asked = questions.select("id", F.posexplode("question").alias("pos", "question"))
    given = answers.select("id", F.posexplode("truth").alias("pos", "truth"))
    known = answers.select("id").distinct().withColumn("found", F.lit(True))
    return asked.join(given, ["id", "pos"], "left").join(known, "id", "left").select(
        "id", "pos", "question", F.coalesce("truth", F.array().cast("array<string>")).alias("truth"), F.coalesce("found", F.lit(False)).alias("found")
    )


def replayed(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, decoded): what a perfect model answers, turn by turn: each turn one step, which is the turn's truth. An id without answers has none."""
    turns = aligned_turns(questions, answers).filter("found")
    listed = turns.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", F.array("truth").alias("steps")))).alias("turns"))
    return listed.select("id", F.transform("turns", lambda t: t["steps"]).alias("decoded"))


def checked(decoded: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, valid): whether an id's steps, turn by turn, are its answers; turns beyond the answers must be empty."""
    both = decoded.join(answers, "id")
    flat = F.transform("decoded", lambda steps: F.flatten(steps))
    n = F.greatest(F.size("decoded"), F.size("truth"))
    empty = F.array().cast("array<string>")
    at = lambda c, k: F.coalesce(F.get(c, k), empty)
    same = F.forall(F.sequence(F.lit(0), n), lambda k: at(F.col("flat"), k) == at(F.col("truth"), k))
    return both.withColumn("flat", flat).select("id", same.alias("valid"))


def content_length(turns_json: Column) -> Column:
    """Summed length of the contents in a JSON text of turns (of the first conversation, if nested); 0 on any error."""
    flat = F.from_json(turns_json, "array<struct<role:string,content:string>>")
    nested = F.from_json(turns_json, "array<array<struct<role:string,content:string>>>")[0]
    turns = F.when(F.ltrim(turns_json).rlike(r"^\[\s*\["), nested).otherwise(flat)
    return F.coalesce(F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.length(t["content"]), F.lit(0))), F.lit(0).cast("long"))


def longest(df: DataFrame, length: str, order: str, *keep: str) -> DataFrame:
    """One row: the row of largest ``length`` (first by ``order``) with the count and the mean; nulls do not count."""
    return df.filter(F.col(length).isNotNull()).agg(
        F.max_by(F.struct(*keep), F.struct(F.col(length), -F.col(order))).alias("row"), F.max(length).alias("max_length"), F.avg(length).alias("mean_length"), F.count(F.lit(1)).alias("n")
    ).select("row.*", "max_length", "mean_length", "n")


def token_counts(df: DataFrame, text: str, tokenize: Callable | None = None) -> DataFrame:
    """Adds ``n_tokens``: words by default; ``tokenize`` takes a pandas Series of texts and returns their token counts."""
    if tokenize is None:
        return df.withColumn("n_tokens", F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long"))
    return df.withColumn("n_tokens", F.pandas_udf(tokenize, "long")(F.coalesce(text, F.lit(""))))
