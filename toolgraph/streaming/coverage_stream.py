"""Coverage counters that live on over calls, as keyed state of a stream.

Each event is a visit of an edge or a start: (epoch, key, visits), with zero
visits for what was only considered. State is one row a key: the newest epoch
seen and the visits in it. A reset is an event of a greater epoch: it voids a
key's counter when it arrives, and keys that no event of the new epoch names are
void for a reader that asks for that epoch. Events of an older epoch change
nothing, so order between batches does not matter. State is kept by the
checkpoint, and a restart goes on from it.

Defined results: null visits count 0 and mark the key as considered, a null
epoch is epoch 0, null keys are one key of their own, repeated events add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from toolgraph.operators.sampling import coverage_ratios

#: keyed state of several columns needs this state store
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
COUNTER = "epoch bigint, key string, visits bigint"


class Counter(StatefulProcessor):
    """Of each key, the newest epoch and its visits; emits the counter as it stands after a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counter = handle.getValueState("counter", "epoch bigint, visits bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        epoch, visits = (int(v) for v in self.counter.get()) if self.counter.exists() else (None, 0)
        for frame in rows:
            for of, part in frame.groupby("epoch"):
                if epoch is None or of > epoch:
                    epoch, visits = int(of), 0
                if of == epoch:
                    visits += int(part["visits"].sum())
        self.counter.update((epoch, visits))
        yield pd.DataFrame({"epoch": [epoch], "key": [key[0]], "visits": [visits]})

    def close(self) -> None:
        pass


def counted(events: DataFrame) -> DataFrame:
    """(epoch, key, visits) of every key that a batch touched, as an update stream. ``events``: a stream (epoch, key, visits)."""
    clean = events.select(F.coalesce(F.col("epoch").cast("long"), F.lit(0)).alias("epoch"), F.col("key").cast("string").alias("key"), F.coalesce(F.col("visits").cast("long"), F.lit(0)).alias("visits"))
    return clean.groupBy("key").transformWithStateInPandas(Counter(), COUNTER, "Update", "none")


def latest(updates: DataFrame) -> DataFrame:
    """(key, visits) of the newest epoch among all updates written so far: what a key was last said to hold.

    Within an epoch counters only grow, so the largest is the last.
    """
    newest = updates.agg(F.max("epoch").alias("newest"))
    live = updates.join(F.broadcast(newest), F.col("epoch") == F.col("newest"))  # one row
    return live.groupBy("key").agg(F.max("visits").alias("visits"))


def stream_ratios(edges: DataFrame, updates: DataFrame) -> DataFrame:
    """Coverage of ``edges`` by the newest epoch, as :func:`coverage_ratios` gives it for one call."""
    return coverage_ratios(edges, latest(updates))
