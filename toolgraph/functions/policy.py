"""Token-level policy-gradient expressions over groups of sampled answers."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from toolgraph.functions.columns import as_column


def log_softmax(logits: Column | str) -> Column:
    logits = as_column(logits)
    top = F.array_max(logits)
    total = F.aggregate(logits, F.lit(0.0), lambda s, x: s + F.exp(x - top))
    return F.transform(logits, lambda x: x - top - F.log(total))


def advantage(reward: Column | str, group: WindowSpec | Column | str) -> Column:
    """Reward standardised within its group by the sample deviation."""
    window = group if isinstance(group, WindowSpec) else Window.partitionBy(group)
    reward = as_column(reward)
    return (reward - F.avg(reward).over(window)) / (F.stddev_samp(reward).over(window) + 1e-8)


def clipped_loss(new: Column | str, old: Column | str, gain: Column | str, eps: float = 0.2) -> Column:
    """Negative minimum of the plain and the clipped ratio times the advantage."""
    ratio = F.exp(as_column(new) - as_column(old))
    gain = as_column(gain)
    return -F.least(ratio * gain, F.least(F.greatest(ratio, F.lit(1.0 - eps)), F.lit(1.0 + eps)) * gain)


def divergence(new: Column | str, ref: Column | str) -> Column:
    """The k3 estimate exp(d) - d - 1 with d = ref - new."""
    d = as_column(ref) - as_column(new)
    return F.exp(d) - d - 1.0


def masked_mean(value: Column | str, mask: Column | str) -> Column:
    """Aggregate: sum of value * mask over sum of mask."""
    return F.try_divide(F.sum(as_column(value) * as_column(mask)), F.sum(as_column(mask)))


def completion_mask(pos: Column | str, prompt_length: Column | str, token: Column | str, pad: int) -> Column:
    return F.when((as_column(pos) >= as_column(prompt_length)) & (as_column(token) != pad), 1).otherwise(0)


def contains_reward(text: Column | str, wanted: str = "6") -> Column:
    return F.when(F.contains(as_column(text), F.lit(wanted)), 1.0).otherwise(0.0)
