"""Model calls in flight, cached embeddings, exact subsamples, repaired rows, files of one document, counts of loads, template tokens, grounding."""

import json
import os
import threading
import time
from collections import Counter
from xml.etree import ElementTree

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.oracle import connect
from toolgraph.operators import build, intents, providers, subsample, template_tokens
from toolgraph.operators.calls import Patience, in_flight
from toolgraph.sources import catalog, file_writer, repair, sinks
from toolgraph.sources.vector_cache import VectorCache


def test_calls_keep_their_order_and_bound():
    lock, now, most = threading.Lock(), [0], [0]

    def slow(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05 if k % 7 else 0.15)
        with lock:
            now[0] -= 1
        return k * k

    assert list(in_flight(slow, range(100), Patience(window=10))) == [k * k for k in range(100)]
    assert most[0] == 10
    assert list(in_flight(slow, [])) == []


def test_calls_retry_and_give_up_in_time():
    tries = Counter()

    def shaky(k):
        tries[k] += 1
        if k == 5:
            time.sleep(60)
        if k == 3 or (k % 2 and tries[k] < 3):
            raise OSError
        return k

    began = time.monotonic()
    assert list(in_flight(shaky, range(8), Patience(window=2, retries=2, pause=0.01, limit=1.0))) == [0, 1, 2, None, 4, None, 6, 7]
    assert time.monotonic() - began < 10 and tries[3] == 3 and tries[0] == 1


def test_a_task_has_twenty_calls_in_flight(spark):
    def model(texts):
        time.sleep(0.05)
        if texts == ["p7"]:
            time.sleep(60)
        return [t.upper() for t in texts]

    rows = spark.createDataFrame([(f"p{k}",) for k in range(200)], "prompt string").coalesce(1)
    providers.replies(rows.limit(1), "prompt", model).collect()  # the worker is up
    began = time.monotonic()
    found = {r.prompt: r.reply for r in providers.replies(rows, "prompt", model, patience=Patience(limit=1.5)).collect()}
    assert time.monotonic() - began < 200 * 0.05 / 2  # one by one it takes ten seconds; job and limit included
    assert found == {f"p{k}": f"P{k}" if k != 7 else None for k in range(200)}


def noted(folder):
    """A provider that leaves a file for each text it is asked for."""

    def embed(texts):
        for t in texts:
            name = f"{time.time_ns()}-{os.getpid()}-{threading.get_ident()}"
            with open(f"{folder}/{name}", "w") as f:
                f.write(t)
        if "broken" in texts:
            raise OSError
        return providers.stub_embedder(4)(texts)

    return embed


def asked_texts(folder):
    found = sorted(open(f"{folder}/{n}").read() for n in os.listdir(folder))
    for n in os.listdir(folder):
        os.remove(f"{folder}/{n}")
    return found


def test_second_build_embeds_new_texts_only(spark, tmp_path):
    folder = tmp_path / "asked"
    folder.mkdir()
    cache = VectorCache(spark, str(tmp_path / "cache"), "stub")
    table = lambda texts: spark.createDataFrame([(k, t, [0.0]) for k, t in enumerate(texts)], "id long, text string, v array<double>")
    first = [f"t{k}" for k in range(99)] + ["t0", None, None]
    rows = cache.embedded(table(first), "text", noted(folder), batch=1).collect()
    assert asked_texts(folder) == sorted(["", *{t for t in first if t}])
    plain = providers.stub_embedder(4)
    assert sorted((r.id, r.text or "", list(r.v)) for r in rows) == sorted((k, t or "", plain([t or ""])[0]) for k, t in enumerate(first))
    rows = cache.embedded(table([*first, "new", "broken"]), "text", noted(folder), batch=1, patience=Patience(retries=0)).collect()
    assert asked_texts(folder) == ["broken", "new"]
    assert [r.v for r in rows if r.text == "broken"] == [None] and len(rows) == 104
    cache.embedded(table(["broken"]), "text", noted(folder), patience=Patience(retries=0)).collect()
    assert asked_texts(folder) == ["broken"]  # a failure is not kept
    cache.append(cache.vectors().limit(5))
    cache.merge()
    assert spark.read.parquet(cache.path).count() == cache.vectors().count() == 101
    assert cache.embedded(table([]), "text", noted(folder)).count() == 0
    VectorCache(spark, cache.path, "other").embedded(table(["t1"]), "text", noted(folder)).collect()
    assert asked_texts(folder) == ["t1"]  # another provider's vectors are others


def test_build_with_a_cache_gives_the_same_graph(spark, tmp_path):
    folder = tmp_path / "asked"
    folder.mkdir()
    tools = spark.createDataFrame([(n, f"about {n}", "general", ({"p": {"description": f"{n} in"}},)) for n in ("a", "b", "c")], "name string, description string, category string, parameters struct<properties:map<string,map<string,string>>>")
    tools = tools.withColumn("parameters", F.struct(F.transform_values("parameters.properties", lambda k, v: F.parse_json(F.to_json(v))).alias("properties")))
    cache = VectorCache(spark, str(tmp_path / "cache"), "stub")
    run = lambda **more: sorted(map(repr, build.build_graph(tools, noted(folder), recall=-1.0, auto=-1.0, verify=False, **more)[1].collect()))
    plain = run()
    assert len(asked_texts(folder)) == 6 and run(cache=cache) == plain
    assert len(asked_texts(folder)) == 6 and run(cache=cache) == plain
    assert asked_texts(folder) == []


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 501, 100_000])
def test_exact_subsample_is_the_least_hashes(spark, sf_dir, n, monkeypatch):
    monkeypatch.setattr(subsample, "ORDERED", 3)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    wanted = connect(sf_dir).execute(f"SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT {n}").fetchall()
    for parts in (1, 5):
        assert sorted(r.o_orderkey for r in subsample.exactly(orders.repartition(parts), "o_orderkey", n).collect()) == sorted(k for (k,) in wanted)


def test_exact_subsample_of_hot_and_null_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("key"), F.col("id"), F.lit(1).alias("__hash1"))
    for n in (1, 1500, 2999):
        got = [r.id for r in subsample.exactly(rows, "key", n).collect()]
        assert len(got) == len(set(got)) == n
    same = spark.createDataFrame([("a", None)] * 50, "key string, x int")
    assert subsample.exactly(same, "key", 20).count() == 20
    assert subsample.exactly(same.limit(0), "key", 20).count() == 0


def test_repairing_source_reads_each_sound_row_once_over_ranges(spark, tmp_path):
    rows, rejects = [], 0
    with open(tmp_path / "rows.jsonl", "w") as f:
        for k in range(2000):
            if k % 9 == 4:
                f.write('{"conversations": [{"role": "us\n' if k % 2 else "[1, 2]\n")
                rejects += 1
            elif k % 9 == 5:
                f.write("\n")
            else:
                calls = [{"function": {"name": "f", "arguments": {"k": k} if k % 2 else None}}] if k % 3 else None
                rows.append(k)
                f.write(json.dumps({"conversations": [{"role": f"r{k}", "content": None, "tool_calls": calls}], "x": k}) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(os.path.getsize(tmp_path / "rows.jsonl") // 4))
    try:
        seen = Observation("rows")
        found = repair.repaired_rows(spark, str(tmp_path), seen)
        assert found.rdd.getNumPartitions() >= 4
        got = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(int(r.messages[0].role[1:]) for r in got) == rows
    assert seen.get == {"lines": 2000, "blank": 222, "rejected": rejects}
    for r in got:
        k = int(r.messages[0].role[1:])
        (m,) = r.messages
        assert m.content == "" and [c.function.arguments for c in m.tool_calls] == ([] if not k % 3 else [json.dumps({"k": k}, separators=(",", ":")) if k % 2 else "{}"])
    (tmp_path / "bare").mkdir()
    (tmp_path / "bare" / "a").write_text('{"x": 1}\n')
    assert [r.messages for r in repair.repaired_rows(spark, str(tmp_path / "bare")).collect()] == [[]]


def test_sniffing_reads_cut_characters_as_text():
    assert repair.looks_like_text("é".encode()[:1]) and repair.looks_like_text(b"") and repair.looks_like_text(("日本" * 9).encode()[:-2])
    assert not repair.looks_like_text(b"a\x00b") and not repair.looks_like_text(b"\xff\xfe\x41\x42\x43\x44")


def test_one_file_an_intent(spark, tmp_path):
    rows = spark.createDataFrame([(f"i{k}", f"é {k}", None if k % 2 else k) for k in range(20)] + [(None, "x", 1), ("a/../b", "y", 2)], "intent_id string, text string, n int").repartition(3)
    path = str(tmp_path / "out")
    file_writer.write_trajectory_files(rows, path)
    assert sorted(os.listdir(path)) == sorted([f"traj_i{k}.json" for k in range(20)] + ["traj_a_.._b.json"])
    assert json.load(open(f"{path}/traj_i3.json")) == {"text": "é 3"} and json.load(open(f"{path}/traj_i4.json")) == {"text": "é 4", "n": 4}
    assert os.listdir(tmp_path) == ["out"]


def test_failed_writes_leave_nothing(spark, tmp_path):
    broken = spark.range(40).repartition(4).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"), F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("body"))
    with pytest.raises(Exception, match="lost"):
        file_writer.file_of_each(broken, "name", "body", str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out")


def test_one_document_of_a_graph(spark, tmp_path):
    nodes = spark.createDataFrame([(f"n{k}", "a<b&\"c") for k in range(30)], "name string, description string").repartition(4)
    edges = spark.createDataFrame([(f"n{k}", f"n{k + 1}", "p") for k in range(29)], "src string, dst string, param string").repartition(3)
    file_writer.file_of_all(sinks.node_link_lines(nodes, edges), str(tmp_path / "graph.json"))
    file_writer.file_of_all(sinks.graphml_document(nodes, edges), str(tmp_path / "graph.graphml"))
    found = json.load(open(tmp_path / "graph.json"))
    assert len(found["nodes"]) == 30 and len(found["links"]) == 29 and found["multigraph"]
    tree = ElementTree.parse(tmp_path / "graph.graphml")
    assert len(tree.findall(".//{*}node")) == 30 and len(tree.findall(".//{*}edge")) == 29
    assert sorted(os.listdir(tmp_path)) == ["graph.graphml", "graph.json"]


def test_load_counts_come_with_the_load(spark, tmp_path):
    lines = ['{"name": "a"}', "", '{"name": "a", "description": "again"}', "{oops", '{"tools": "[{\\"name\\": \\"b\\"}, {\\"description\\": \\"nameless\\"}]"}', '{"tools": "not json"}']
    (tmp_path / "tools.jsonl").write_text("\n".join(lines))
    tools, seen = catalog.load_catalog(spark, str(tmp_path))
    assert seen == {"lines": 6, "blank": 1, "unreadable": 1, "records": 2, "tools": 2}
    assert sorted(r.name for r in tools.collect()) == ["a", "b"]


@pytest.mark.parametrize("text, n", [
    ('[{"role": "user", "content": "a b"}]', 3), ('[[{"role": "user", "content": "a b"}], [{"role": "x", "content": "c"}]]', 3), ('[{"content": "a b"}, {"content": null}, {"content": " c"}]', 3),
    ('[{"role": "user", "content": null}]', 2), ('{"role": "user"}', 0), ("[1, 2]", 0), ("[]", 0), ("{", 0), ("", 0), (None, 0),
])
def test_template_tokens(spark, text, n):
    assert spark.createDataFrame([(text,)], "t string").select(template_tokens.template_tokens(F.col("t"))).first()[0] == n


def test_grounding(spark):
    cases = [('{"a": "Rome", "n": 7}', "from Rome at 7", ["b"], True, True), ('{"a": "Oslo"}', "from Rome", None, False, True), ('{"a": null}', "null", [], False, True), ('{"a": [1]}', "[1]", ["a"], False, False), ("{}", "q", ["a"], True, True), ('{"a": true}', None, [], False, True)]
    df = spark.createDataFrame([(s, q, c) for s, q, c, *_ in cases], "s string, q string, c array<string>")
    fits = intents.grounded(F.col("q"), F.parse_json("s").cast("map<string,variant>"), F.col("c"))
    assert [tuple(r.f) for r in df.select(fits.alias("f")).collect()] == [(a, b) for *_, a, b in cases]
