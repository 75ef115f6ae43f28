"""Simulated conversations: one group a task row, three models inside, the memory as rows outside.

Conversations are independent, so Spark deals them out by intent; inside one,
turns follow each other. The result is the memory that
:func:`toolgraph.operators.chat.chat_rows` turns into training rows.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame

from toolgraph.functions.text import SIMULATION_FAILED, STOP, STOP_FAILED
from toolgraph.operators.chat import BLOCKS
from toolgraph.scratch import materialize

MAX_TURNS = 10
MAX_STEPS = 10
MEMORY = f"conv_id string, turn int, name string, role string, blocks {BLOCKS}"
#: (query, memory so far) to the user's next text
UserModel = Callable[[str, list[dict]], str]
#: (tools, memory so far) to text and tool calls [(id, name, arguments JSON)]
AssistantModel = Callable[[list[str], list[dict]], tuple[str, list[tuple[str, str, str]]]]
#: (tool name, arguments JSON, memory so far) to the tool's output JSON
ToolModel = Callable[[str, str, list[dict]], str]


def block(kind: str, text: str | None = None, call: tuple | None = None, output: str | None = None) -> dict:
    call_id, name, arguments = call or (None, None, None)
    return {"type": kind, "text": text, "id": call_id, "name": name, "input": arguments if kind == "tool_use" else None, "output": output}


def converse(query: str, tools: list[str], user: UserModel, assistant: AssistantModel, tool: ToolModel, max_turns: int, max_steps: int) -> list[dict]:
    """The first user turn is the query. More than ``max_turns`` user turns fail the conversation; a reply with the stop word ends it."""
    memory: list[dict] = []

    def say(name: str, role: str, *blocks: dict) -> None:
        memory.append({"turn": len(memory), "name": name, "role": role, "blocks": list(blocks)})

    turn = 0
    while True:
        turn += 1
        try:
            text = STOP_FAILED if turn > max_turns else query if turn == 1 else user(query, memory)
        except Exception:  # without a user the conversation has failed
            text = STOP_FAILED
        if turn > 1 and text != STOP_FAILED and STOP in text:
            text = STOP
        say("user", "user" if turn == 1 or text == STOP_FAILED else "assistant", block("text", text))
        if text in (STOP, STOP_FAILED):
            return memory
        for _ in range(max_steps):
            try:
                text, calls = assistant(tools, memory)
            except Exception:  # as above; the user speaks next
                break
            said = [block("text", text)] if text else []
            say("assistant", "assistant", *said, *[block("tool_use", call=c) for c in calls])
            if not calls:
                break
            for call in calls:
                try:
                    output = tool(call[1], call[2], memory)
                except Exception:  # a provider may fail in any way; the conversation goes on with an error object
                    output = SIMULATION_FAILED
                say("system", "system", block("tool_result", call=call, output=output or "{}"))


def simulate(intents: DataFrame, user: UserModel, assistant: AssistantModel, tool: ToolModel, max_turns: int = MAX_TURNS, max_steps: int = MAX_STEPS) -> DataFrame:
    """Memory rows (conv_id, turn, name, role, blocks) of one conversation for each intent (id, query, tools), written once."""

    def run(frames):
        for frame in frames:
            rows = [
                {"conv_id": str(i), **m}
                for i, q, t in zip(frame["id"], frame["query"], frame["tools"], strict=True)
                for m in converse(q or "", list(t) if t is not None else [], user, assistant, tool, max_turns, max_steps)
            ]
            yield pd.DataFrame(rows, columns=["conv_id", "turn", "name", "role", "blocks"])

    wanted = intents.select("id", "query", "tools").dropDuplicates(["id"]).repartition("id")
    return materialize(wanted.mapInPandas(run, MEMORY), "memory")
