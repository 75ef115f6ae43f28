"""Text expressions with Python's semantics where the data were made by Python."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from toolgraph.functions.columns import as_column, once

#: fixed values: roles of tagged conversations and what they are called in chat rows
ROLE_NAMES = {"human": "user", "gpt": "assistant", "function_call": "tool_call", "observation": "tool_response"}
#: fixed values: replies with which a simulated user ends a conversation
STOP, STOP_FAILED = "TERMINATE", "TERMINATE_FAILED"
#: fixed value: what a tool simulator answers when its model fails
SIMULATION_FAILED = '{"status": "error", "message": "Simulation internal error"}'
#: fixed value: the empty reasoning block put in front of an answer
EMPTY_THINK = "<think>\n\n</think>\n\n"


def strip(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), r"^\s+|\s+$", "")


def title(text: Column | str) -> Column:
    """Strips and title-cases like ``str.title``: a letter after anything but a letter is a capital."""
    runs = F.regexp_extract_all(strip(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def percent(text: Column | str) -> Column:
    """``37.62%`` and plain numbers as a double; 0 for what is neither."""
    number = strip(F.regexp_replace(strip(text), r"%+$", ""))
    plain = number.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.coalesce(F.when(plain, number.try_cast("double")), F.lit(0.0))


def chat_role(tag: Column | str) -> Column:
    """Chat role of a tagged turn; unknown tags are users."""
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, as_column(tag)), F.lit("user"))


def with_empty_think(text: Column | str) -> Column:
    """An empty reasoning block after every assistant header line."""
    return F.replace(as_column(text), F.lit("assistant\n"), F.lit("assistant\n" + EMPTY_THINK))


def is_control(content: Column | str) -> Column:
    """Exactly one of the stop words."""
    return as_column(content).isin(STOP, STOP_FAILED)


def is_json(text: str) -> bool:
    """Whether the whole text is one JSON value; ``NaN`` and infinities are none, repeated keys are allowed."""
    try:
        json.loads(text, parse_int=str, parse_float=str, parse_constant=int)  # int() refuses NaN
    except (ValueError, RecursionError):
        return False
    return True


def valid_json(text: Column | str, otherwise: str | None = None) -> Column:
    """The text if all of it is one JSON value, else ``otherwise``; null stays null. Spark's ``parse_json`` ignores what follows the first value."""

    def checked(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None or is_json(t) else otherwise for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(checked, "string")(as_column(text))


def first_json(text: Column | str) -> Column:
    """The whole text if it is JSON; else the shortest ``{...}``, which cuts nested objects and then is no JSON; else null."""
    text = as_column(text)
    whole = F.when(text.rlike(r"^\s*+([\[{\"\-0-9]|true|false|null)"), strip(text))  # prose is not sent to Python
    inner = F.nullif(F.regexp_extract(text, r"(?s)\{.*?\}", 0), F.lit(""))
    return F.coalesce(valid_json(whole), valid_json(inner))


def braces_slice(text: Column | str) -> Column:
    """Without code fences, from the first ``{`` to the last ``}``; null without a ``{``, empty without a ``}`` after it."""
    bare = F.replace(F.replace(as_column(text), F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    opened = once(bare, lambda b: F.when(F.contains(b, F.lit("{")), F.regexp_replace(b, r"^[^{]*+", "")))
    return once(opened, lambda o: F.left(o, F.length(o) - F.length(F.substring_index(o, "}", -1))))


def simulated_output(text: Column | str) -> Column:
    """A tool simulator's reply as JSON text: its object, or an error object if it has none or a broken one."""
    return F.coalesce(valid_json(braces_slice(text), '{"error": "Internal simulation error"}'), F.lit('{"error": "Simulation format error"}'))


def tool_calls(text: Column | str) -> Column:
    """The JSON array of tool calls in a reply: a fenced block, else the first ``[`` to the last ``]``; null if there is none.

    ``}{`` between calls is repaired, and a single call is wrapped.
    """
    text = as_column(text)
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    end = F.length(text) - F.locate("]", F.reverse(text)) + 1
    bracket = F.when((F.locate("[", text) > 0) & F.contains(text, F.lit("]")) & (end >= F.locate("[", text)), F.substring(text, F.locate("[", text), end - F.locate("[", text) + 1))
    raw = strip(F.when(fenced != "", fenced).otherwise(bracket))
    joined = F.regexp_replace(raw, r"\}\s*\{", "},{")
    wrapped = F.when(joined.startswith("{"), F.concat(F.lit("["), joined, F.lit("]"))).otherwise(joined)
    return valid_json(wrapped)


def content_text(blocks: Column | str) -> Column:
    """Text blocks of a message, concatenated."""
    return F.array_join(F.transform(F.filter(as_column(blocks), lambda b: b["type"] == "text"), lambda b: F.coalesce(b["text"], F.lit(""))), "")
