"""Token counts of conversations under a chat template, with fallbacks.

A JSON text of turns is parsed (of a nested list, the first conversation counts),
rendered by a template and counted by a tokenizer. Where the template fails, for
example on a turn without a role, the contents are counted one after the other;
where that fails too, or the text is no list, the count is 0. The tokenizer is any
callable from text to a count; each Python worker loads it once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: from a list of turns to the text that a model reads; raises on turns it can't render
Template = Callable[[list[dict[str, Any]]], str]
Counter = Callable[[str], int]
WORD = re.compile(r"\S+", re.ASCII)


def chatml(turns: list[dict[str, Any]]) -> str:
    """Each turn between start and end marks, its role on the first line. A null content is empty."""
    return "".join(f"<|im_start|>{t['role']}\n{t['content'] if t['content'] is not None else ''}<|im_end|>\n" for t in turns)


def word_counter() -> Counter:
    return lambda text: len(WORD.findall(text))


def conversation(text: str | None) -> list | None:
    """The turns of a JSON text, or of the first conversation in it; None if there is no list."""
    try:
        found = json.loads(text) if text is not None else None
    except ValueError:
        return None
    if isinstance(found, list) and found and isinstance(found[0], list):
        found = found[0]
    return found if isinstance(found, list) else None


def counted(text: str | None, template: Template, count: Counter) -> int:
    turns = conversation(text)
    if turns is None:
        return 0
    try:
        return count(template(turns))
    except Exception:  # templates and tokenizers raise what they like
        try:
            return count("".join(str(t["content"]) for t in turns if t.get("content")))
        except Exception:  # as above
            return 0


def template_tokens(turns: Column, load: Callable[[], Counter] = word_counter, template: Template = chatml) -> Column:
    """The token count of each JSON text of turns; ``load`` makes the tokenizer, once a worker's task."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = load()
        for texts in batches:
            yield pd.Series([counted(t, template, count) for t in texts], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}  # real types, for Spark to see the kind of function
    return F.pandas_udf(run, "long")(turns)
