"""Fingerprints, ids, and uniform numbers from hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from toolgraph.functions.columns import as_column, once


def uniform(*keys: Column | str | int) -> Column:
    """A number in (0, 1] from an md5 of the keys: the same in every run, on any partitioning, and in other SQL engines."""
    text = F.concat_ws("|", *[F.lit(str(k)) if isinstance(k, int) else as_column(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") + 1) / F.lit(float(1 << 52))


def edge_signature(edges: Column | str) -> Column:
    """``from->to`` of each edge, sorted, joined by a bar. Parameters do not count; repeated pairs do."""
    return F.array_join(F.array_sort(F.transform(as_column(edges), lambda e: F.concat(e["from"], F.lit("->"), e["to"]))), "|")


def skeleton_id(edges: Column | str) -> Column:
    return F.concat(F.lit("skel_"), F.md5(edge_signature(edges)))


def json_string(text: Column | str) -> Column:
    """A string as Python's ``json.dumps(ensure_ascii=False)`` writes it, with escapes in lower case."""
    out = as_column(text)
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))

    def rare(text: Column) -> Column:
        for code in [*range(0x08), 0x0B, *range(0x0E, 0x20)]:
            text = F.replace(text, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
        return text

    out = once(out, lambda t: F.when(t.rlike(r"[\x00-\x1f]"), rare(t)).otherwise(t))
    return F.concat(F.lit('"'), out, F.lit('"'))


def intent_id(query: Column | str, tools: Column | str, initial_keys: Column | str, final_keys: Column | str) -> Column:
    """md5 of the sorted JSON text of query, tools and state keys; values of the states do not count."""
    names = lambda c: F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(as_column(c)), json_string), ", "), F.lit("]"))
    return F.md5(
        F.concat(
            F.lit('{"final_keys": '), names(final_keys), F.lit(', "init_keys": '), names(initial_keys),
            F.lit(', "q": '), json_string(query), F.lit(', "tools": '), names(tools), F.lit("}"),
        )
    )
