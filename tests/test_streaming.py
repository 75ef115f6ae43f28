"""Streams: counters over micro-batches, and a ledger that replays do not double."""

import json

import pytest

from toolgraph.operators.sampling import coverage_ratios
from toolgraph.streaming import coverage_stream
from toolgraph.streaming.progress import Ledger

EVENTS = "epoch long, key string, visits long"


@pytest.fixture()
def rocksdb(spark):
    key, value = coverage_stream.STATE_STORE
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    yield
    spark.conf.set(key, before)


def events(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("epoch", "key", "visits"), r, strict=True))) for r in rows) + "\n")


def test_coverage_of_micro_batches_equals_one_call_and_restarts(spark, tmp_path, rocksdb):
    def run():
        """One start of the query: takes what is new, then stops."""
        source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        ledger = Ledger(spark, str(tmp_path / "out"), "coverage", coverage_stream.COUNTER)
        query = coverage_stream.counted(source).writeStream.outputMode("update").foreachBatch(ledger.sink()).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return ledger.rows()

    held = lambda updates: {r.key: r.visits for r in coverage_stream.latest(updates).collect()}
    edges = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    first, second = [(0, "a", 2), (0, "b", 0), (0, None, 1), (0, "a", None)], [(0, "a", 1), (0, "c", 3), (None, "b", 1)]
    events(tmp_path / "in", "1.json", first)
    events(tmp_path / "in", "2.json", second)
    updates = run()
    assert held(updates) == {"a": 3, "b": 1, "c": 3, None: 1}
    one_call = spark.createDataFrame([("a", 3), ("b", 1), ("c", 3), (None, 1)], "key string, visits long")
    assert coverage_stream.stream_ratios(edges, updates).collect() == coverage_ratios(edges, one_call).collect()
    events(tmp_path / "in", "3.json", [(0, "a", 4), (0, "d", 0)])
    assert held(run()) == {"a": 7, "b": 1, "c": 3, "d": 0, None: 1}  # state came back from the checkpoint
    events(tmp_path / "in", "4.json", [(1, "b", 1), (0, "c", 9)])
    assert held(run()) == {"b": 1}  # a greater epoch resets; what is late counts nowhere
    events(tmp_path / "in", "5.json", [(0, "b", 9), (1, "b", 2)])
    assert held(run()) == {"b": 3}


def test_ledger_replays_append_nothing(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), "scores", "id long, score double")
    every = spark.createDataFrame([(k, "x") for k in range(6)] + [(None, "x")], "id long, text string")
    assert ledger.rows().count() == 0 and ledger.remaining(every, "id").count() == 7
    batch = spark.createDataFrame([(0, 0.5), (1, 0.25), (None, 0.0)], "id long, score double")
    write = ledger.sink()
    write(batch, 0)
    write(batch, 0)  # the same batch again, after a failure
    assert ledger.rows().count() == 3
    write(spark.createDataFrame([(4, 1.0)], "id long, score double"), 1)
    assert sorted(r.id for r in ledger.remaining(every.filter("id IS NOT NULL"), "id").collect()) == [2, 3, 5]
    assert ledger.remaining(every, "id").filter("id IS NULL").count() == 1
    assert Ledger(spark, str(tmp_path), "other", "id long, score double").rows().count() == 0


def test_ledger_resumes_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    ledger = Ledger(spark, str(tmp_path / "done"), "lines", "value string")

    def run():
        source = spark.readStream.text(str(tmp_path / "in"))
        query = source.writeStream.foreachBatch(ledger.sink(lambda rows: rows.filter("value <> ''"))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(60)
        return sorted(r.value for r in ledger.rows().collect())

    (tmp_path / "in" / "1.txt").write_text("a\n\nb\n")
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    (tmp_path / "in" / "2.txt").write_text("b\nc\n")
    assert run() == ["a", "b", "b", "c"]
