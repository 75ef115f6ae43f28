"""Preference formatting: one prompt, two masked completions.

A chosen and a rejected conversation are compared turn by turn; their longest
common prefix is rendered once as the prompt, and what follows in each is its
completion, with a mask that trains assistant turns only. A conversation's turns
are gathered into one row; a pair is two such rows, whose turns are compared place
by place with array functions, and the prefix ends before the first place where
role or text differ or one conversation is over.

:func:`preference_pairs` makes pairs from a table of conversations: among
conversations that open with the same turn, the best one (most assistant
characters, then smallest conv_id) is chosen over each of the others. That is
one row a conversation: the best of a group, or one alone, has no pair of its
own and comes back with a null rejected side, so nothing is dropped. A hot
opening turn joins by shuffles that adaptive execution splits, and never gives
pairs of all with all.

Defined results: turns are ordered by turn, then role and text; turns repeated
exactly are separate turns. A null role counts as ``user``, a null text as
empty. A null conv_id is left out. If two conversations are equal, the prompt
is all of both and both completions are empty (``differs`` is false). Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolgraph.scratch import materialize

BEGIN, BETWEEN, END = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, turns (array of role, text), opening, spoken (assistant characters)."""
    clean = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    gathered = clean.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("ordered"),
        F.sum(F.when(F.col("role") == TRAINED_ROLE, F.length("text")).otherwise(0)).alias("spoken"),
    )
    turns_of = F.transform("ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return gathered.select("conv_id", turns_of.alias("turns"), F.sha2(F.to_json(F.struct(turns_of[0].alias("t"))), 256).alias("opening"), "spoken")


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), turn["role"], F.lit(BETWEEN), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask_spans(turns: Column) -> Column:
    """(start, end) character spans of a rendered completion that are trained on: assistant texts with their end marks."""
    head = lambda t: F.lit(len(BEGIN) + len(BETWEEN)) + F.length(t["role"])
    whole = lambda t: head(t) + F.length(t["text"]) + len(END)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(held: Column, t: Column) -> Column:
        span = F.struct((held["at"] + head(t)).alias("start"), (held["at"] + whole(t)).alias("end"))
        spans = F.when(t["role"] == TRAINED_ROLE, F.concat(held["spans"], F.array(span))).otherwise(held["spans"])
        return F.struct((held["at"] + whole(t)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def common_prefix(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that two conversations share."""
    n = F.least(F.size(chosen), F.size(rejected))
    same = F.zip_with(F.slice(chosen, F.lit(1), n), F.slice(rejected, F.lit(1), n), lambda a, b: a == b)
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, n).otherwise(first_other - 1).cast("int")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Adds prompt, completions and masks to rows with array columns ``chosen`` and ``rejected`` (role, text)."""
    other = F.coalesce("rejected", F.array().cast("array<struct<role:string,text:string>>"))
    shared = F.when(F.col("rejected").isNull(), F.size("chosen")).otherwise(common_prefix(F.col("chosen"), F.col("rejected")))
    cut = pairs.withColumn("prefix_turns", shared)
    rest = lambda turns: F.slice(turns, F.col("prefix_turns") + 1, F.greatest(F.size(turns) - F.col("prefix_turns"), F.lit(0)))
    cut = cut.withColumns({"kept_turns": rest(F.col("chosen")), "lost_turns": rest(other)})
    return cut.withColumns({
        "prompt": render(F.slice("chosen", F.lit(1), F.col("prefix_turns"))),
        "chosen_completion": render(F.col("kept_turns")),
        "rejected_completion": render(F.col("lost_turns")),
        "chosen_mask": mask_spans(F.col("kept_turns")),
        "rejected_mask": mask_spans(F.col("lost_turns")),
        "differs": (F.size("kept_turns") > 0) | (F.size("lost_turns") > 0),
    }).drop("kept_turns", "lost_turns")


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen_id, rejected_id, chosen, rejected): every conversation against the best with its opening turn."""
    whole = materialize(conversations(turns), "conversations")
    best = whole.groupBy("opening").agg(F.max(F.struct("spoken", (-F.col("conv_id")).alias("low"))).alias("best")).select("opening", (-F.col("best.low")).alias("chosen_id"))
    best = materialize(best, "best-of-opening")  # so the join's sides are plain shuffles, which adaptive execution splits
    paired = whole.join(best, "opening").withColumn("is_best", F.col("conv_id") == F.col("chosen_id"))
    chosen = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    return paired.join(chosen, "chosen_id").select(
        "conv_id",
        "chosen_id",
        F.when(~F.col("is_best"), F.col("conv_id")).alias("rejected_id"),
        "chosen",
        F.when(~F.col("is_best"), F.col("turns")).alias("rejected"),
    )


def op4_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = format_pairs(preference_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    spans = lambda mask: F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return formatted.select(
        "conv_id",
        "chosen_id",
        "rejected_id",
        "prefix_turns",
        "differs",
        *[F.sha2(c, 256).alias(f"{c}_sha256") for c in ("prompt", "chosen_completion", "rejected_completion")],
        spans("chosen_mask").alias("chosen_spans"),
        spans("rejected_mask").alias("rejected_spans"),
    )


SQL = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, 'user'), coalesce(text, '')) AS pos,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS n, CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS spoken,
         min(CASE WHEN pos = 1 THEN role || chr(0) || text END) AS opening
  FROM t GROUP BY conv_id),
b AS (SELECT conv_id, n, first_value(conv_id) OVER (PARTITION BY opening ORDER BY spoken DESC, conv_id) AS chosen_id FROM c),
p AS (
  SELECT b.conv_id, b.chosen_id, CASE WHEN b.conv_id <> b.chosen_id THEN b.conv_id END AS rejected_id, b.n, k.n AS kn
  FROM b JOIN c k ON k.conv_id = b.chosen_id),
d AS (
  SELECT p.conv_id, min(x.pos) AS first_other
  FROM p JOIN t x ON x.conv_id = p.chosen_id JOIN t y ON y.conv_id = p.conv_id AND y.pos = x.pos
  WHERE x.role <> y.role OR x.text <> y.text GROUP BY p.conv_id),
q AS (
  SELECT p.*, CAST(CASE WHEN rejected_id IS NULL THEN kn ELSE coalesce(d.first_other - 1, least(n, kn)) END AS INT) AS prefix_turns
  FROM p LEFT JOIN d USING (conv_id)),
r AS (
  SELECT conv_id, pos, role, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece, 13 + length(role) AS head FROM t),
sides AS (
  SELECT q.conv_id, s.side, r.pos, r.role, r.piece, r.head,
         sum(length(r.piece)) OVER (PARTITION BY q.conv_id, s.side ORDER BY r.pos) - length(r.piece) AS at_char
  FROM q CROSS JOIN (VALUES ('p'), ('c'), ('r')) s(side)
  JOIN r ON r.conv_id = CASE s.side WHEN 'r' THEN q.rejected_id ELSE q.chosen_id END
        AND CASE s.side WHEN 'p' THEN r.pos <= q.prefix_turns ELSE r.pos > q.prefix_turns END),
a AS (
  SELECT conv_id, side, string_agg(piece, '' ORDER BY pos) AS body,
         string_agg(CASE WHEN role = 'assistant' THEN (at_char + head) || '-' || (at_char + length(piece)) END, ',' ORDER BY pos) AS spans
  FROM sides GROUP BY conv_id, side)
SELECT q.conv_id, q.chosen_id, q.rejected_id, q.prefix_turns, (c.body IS NOT NULL OR j.body IS NOT NULL) AS differs,
       sha256(coalesce(p.body, '')) AS prompt_sha256, sha256(coalesce(c.body, '')) AS chosen_completion_sha256,
       sha256(coalesce(j.body, '')) AS rejected_completion_sha256, coalesce(c.spans, '') AS chosen_spans, coalesce(j.spans, '') AS rejected_spans
FROM q LEFT JOIN a p ON p.conv_id = q.conv_id AND p.side = 'p'
       LEFT JOIN a c ON c.conv_id = q.conv_id AND c.side = 'c'
       LEFT JOIN a j ON j.conv_id = q.conv_id AND j.side = 'r'
"""
