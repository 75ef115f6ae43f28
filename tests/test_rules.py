"""Literal cases of rules that are easy to get wrong."""

import hashlib
import json
from xml.etree import ElementTree

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolgraph.config import Settings
from toolgraph.functions import policy, text
from toolgraph.functions.hashing import edge_signature, intent_id, json_string, skeleton_id
from toolgraph.operators import build, chat, graph, intents, providers, sampling, scores, similarity, simulation
from toolgraph.operators.components import connected_components
from toolgraph.sources import catalog, sinks
from toolgraph.streaming.catalog_stream import stream_catalog


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given_, wanted", [(" e-commerce nft's x2y ", "E-Commerce Nft'S X2Y"), ("", ""), (None, None)])
def test_title(spark, given_, wanted):
    assert one(spark, text.title("t"), t=given_) == wanted


def test_similarity_join_sends_vectors_to_few_tasks_and_keeps_all_matches(spark, monkeypatch):
    assert [similarity.n_groups(n, 64) for n in (0, 1, 2049, 50_000, 615_000, 2_000_000)] == [1, 1, 2, 16, 16, 16]
    assert similarity.n_groups(20_000_000, 64) == 153 and similarity.n_groups(100_000, 1536) == 19  # full groups
    monkeypatch.setattr(similarity, "GROUPS", 3)
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=(41, 16))] * 7)  # copies tie: the smaller id comes first
    rows = spark.createDataFrame([(k, v[k].tolist()) for k in range(len(v))], "id long, v array<double>").withColumn("v", F.col("v").cast("array<float>"))
    found = similarity.top_matches(rows.select(F.col("id").alias("producer"), "v"), rows.select(F.col("id").alias("consumer"), F.lit("p").alias("param"), "v"), 0.2, 9, block=25)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("sequence(0, 2,") == 2  # three groups a side, not twelve
    got = {(r.consumer, r.producer) for r in found.collect()}
    u = v.astype("f4").astype(float)[:41]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    scores = np.round(u @ u.T, 12)[np.arange(len(v)) % 41][:, np.arange(len(v)) % 41]
    assert got == {(c, p) for c in range(len(v)) for p in sorted(range(len(v)), key=lambda p: (-scores[c, p], p))[:9] if scores[c, p] > 0.2}


def test_fences_are_cut_and_text_is_escaped_once_a_row(spark):
    reply = F.concat(F.lit("```json"), json_string("t"), F.lit("```"))
    rows = spark.createDataFrame([('{"a": "{}"} \v\x01"',), (None,), ("} {",), ("a } b",), ("x {{a} } y",)], "t string").select("t", text.simulated_output(reply).alias("x"), text.braces_slice("t").alias("cut"), json_string("t").alias("j")).cache()
    assert [(r.cut, json.loads(r.j) if r.j else None) for r in rows.collect()] == [('{"a": "{}"}', '{"a": "{}"} \v\x01"'), (None, None), ("", "} {"), (None, "a } b"), ("{{a} }", "x {{a} } y")]
    plan = spark.createDataFrame([("",)], "t string").select(text.simulated_output(reply))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("```json") <= 4  # put on and taken off once; the plan names the call of Python twice


def test_json_with_more_behind_it_is_no_json(spark):
    reply = '4703443633 Ach. Answer: {"valid": true} 4703443633 Ach.'
    assert one(spark, text.first_json("t"), t=reply) == '{"valid": true}' and one(spark, providers.verdict("t"), t=reply)
    assert one(spark, text.first_json("t"), t=' {"a": 1, "a": [2]} ') == '{"a": 1, "a": [2]}'
    assert one(spark, text.first_json("t"), t=' "all" ') == '"all"' and one(spark, text.first_json("t"), t="1], [2") is None
    assert "Internal" in one(spark, text.simulated_output("t"), t='{"a": 1} and }')
    assert one(spark, text.tool_calls("t"), t='[{"name": "a"}] or [1]') is None
    assert [text.is_json(t) for t in ('{"a": 1e5}', "NaN", "-Infinity", "9" * 5000, "[" * 10**6, "")] == [True, False, False, True, False, False]
    assert catalog.catalog(spark.createDataFrame([(1, '{"name": "a"} {"name": "b"}'), (2, '{"name": "c"}')], "ord long, line string"))[0].select("name").collect() == [("c",)]


@pytest.mark.parametrize("given_, wanted", [("37.62%", 37.62), ("12.5", 12.5), ("N/A", 0.0), ("", 0.0), (None, 0.0), ("3%7", 0.0), ("%5", 0.0), ("1d", 0.0), (" -2.5e1% ", -25.0)])
def test_percent(spark, given_, wanted):
    assert one(spark, text.percent("t"), t=given_) == wanted


def test_json_cuts(spark):
    assert one(spark, text.first_json("t"), t='x {"valid": true} y') == '{"valid": true}'
    assert one(spark, text.first_json("t"), t='x {"v": {"a":1}} y') is None
    assert one(spark, text.first_json("t"), t="none") is None
    assert one(spark, text.simulated_output("t"), t='```json\n{"a":1}\n```') == '{"a":1}'
    assert "format" in one(spark, text.simulated_output("t"), t="[1]")
    assert "Internal" in one(spark, text.simulated_output("t"), t='{"a":')
    assert one(spark, text.tool_calls("t"), t='[{"name":"a"}]') == '[{"name":"a"}]'
    assert one(spark, text.tool_calls("t"), t="no brackets") is None
    assert json.loads(one(spark, text.tool_calls("t"), t='```json\n{"name":"a"}{"name":"b"}\n```')) == [{"name": "a"}, {"name": "b"}]


def test_signature_and_ids(spark):
    edges = spark.createDataFrame([([("b", "c"), ("a", "b")],)], "e array<struct<from:string,to:string>>")
    assert edges.select(edge_signature("e")).first()[0] == "a->b|b->c"
    assert edges.select(skeleton_id("e")).first()[0] == "skel_6fa818b97fb610d060b03a75aa76ea50"
    made = intent_id("q", F.array(F.lit("ip_info"), F.lit("geo")), F.array(F.lit("ip")), F.array(F.lit("city")))
    assert one(spark, made, q="Where is 1.2.3.4?") == "35b2e2a43f257f82707cfd2810bc3da3"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=20))
def test_intent_id_is_pythons(spark, q):
    want = hashlib.md5(json.dumps({"q": q, "tools": ["t"], "init_keys": [], "final_keys": ["k"]}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert one(spark, intent_id("q", F.array(F.lit("t")), F.array().cast("array<string>"), F.array(F.lit("k"))), q=q) == want


def test_catalog_rules(spark):
    tool = lambda name, d="d": {"name": name, "description": d, "parameters": {"type": "object", "properties": {"p": {"description": "x"}}, "required": ["p"]}}
    lines = [
        json.dumps(tool("A", "1")), json.dumps(tool("A", "2")), "not json", "", json.dumps({"tools": "not json"}), json.dumps({"tools": [tool("L")]}),
        json.dumps({"tools": json.dumps([tool("B"), {"description": "nameless"}, tool("C")])}), json.dumps({"function": tool("E")}), json.dumps({"name": "N", "description": None}), json.dumps({"name": "D"}),
    ]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "ord long, line string")
    tools, counted = catalog.catalog(df)
    assert {(r.name, r.description) for r in tools.collect()} == {("A", "1"), ("B", "d"), ("E", "d"), ("D", "")}
    assert {r.ord for r in counted.filter("counted").collect()} == {0, 1, 7, 9}
    assert {r.name: r.description for r in catalog.tool_map(df.filter("ord < 2")).collect()} == {"A": "2"}
    assert {r.text for r in catalog.consumer_texts(tools).collect()} == {"Parameter p: x"}


def test_similarity_rules(spark):
    p = spark.createDataFrame([("A", [1.0, 0.0]), ("B", [0.9, 0.1]), ("Z", [0.0, 0.0])], "producer string, v array<double>")
    c = spark.createDataFrame([("A", "x", [1.0, 0.0]), ("A", "y", None)], "consumer string, param string, v array<double>")
    best = similarity.top_matches(p, c, 0.7, 1)
    assert [(r.producer, r.param) for r in best.collect()] == [("A", "x")]
    assert similarity.without_self(best).count() == 0  # the self match used up the place
    scored = spark.createDataFrame([(0.8,), (0.75,)], "s double")
    routes = [[r[0] for r in scored.select(similarity.route(F.col("s"), 0.8, v, m)).collect()] for v, m in ((True, True), (True, False), (False, False))]
    assert routes == [["direct", "verify"], ["direct", "drop"], ["direct", "direct"]]
    assert similarity.top_matches(p, c, 1.0, 5).count() == 0  # strictly above


def test_graph_rules(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    edges = spark.createDataFrame([("a", "b", "a->b:p", "p", 0.8), ("a", "b", "a->b:q", None, 0.8)], "src string, dst string, key string, parameter string, weight double")
    assert {r.name for r in graph.prune(nodes, edges).collect()} == {"a", "b"}
    assert {r.name: (r.out_degree, r.in_degree) for r in graph.degrees(edges, nodes).collect()} == {"a": (2, 0), "b": (0, 2), "c": (0, 0)}
    stats = {r.metric: r.value for r in graph.statistics(nodes, edges).collect()}
    assert stats["density"] == "0.33333" and stats["isolates"] == "1" and stats["top_parameters"] == "p(1), unknown(1)"
    visits = spark.createDataFrame([("a->b:p", 3)], "key string, visits long")
    assert {r.key: r.decayed for r in sampling.weighted_edges(edges, visits).collect()} == {"a->b:p": 0.2, "a->b:q": 0.8}
    loop = spark.createDataFrame([("a", "b", "k1", 1.0), ("b", "a", "k2", 1.0)], "src string, dst string, key string, weight double")
    kept, cover = sampling.generate(loop, 5, 3, 3, batch=4, max_idle_rounds=2)
    assert kept.count() == 0 and cover.node_visits.agg(F.sum("visits")).first()[0] >= 2
    assert connected_components(edges.limit(0)).count() == 0


def test_chat_rules(spark):
    block = "struct<type:string,text:string,id:string,name:string,input:string,output:string>"
    t = lambda s: [("text", s, None, None, None, None)]
    rows = [
        ("c", 0, "user", "user", t("hi")), ("c", 1, "assistant", "assistant", [("text", "", None, None, None, None), ("tool_use", None, "1", "f", '{"a":1}', None)]),
        ("c", 2, "system", "system", [("tool_result", None, "1", "f", None, "r1"), ("tool_result", None, "2", "g", None, "r2")]),
        ("c", 3, "Environment", "assistant", t("lost")), ("c", 4, "user", "assistant", t("TERMINATE now")), ("c", 5, "user", "user", t("TERMINATE")),
    ]
    memory = spark.createDataFrame(rows, f"conv_id string, turn int, name string, role string, blocks array<{block}>")
    got = chat.chat_rows(memory).first().messages
    assert [(m.role, m.content) for m in got] == [("user", "hi"), ("assistant", None), ("tool", "r1"), ("tool", "r2"), ("user", "TERMINATE now")]
    assert got[1].tool_calls[0].function.arguments == '{"a":1}' and got[0].tool_calls is None
    raw = '[{"role":"assistant","content":null,"tool_calls":[{"function":{"name":"f","arguments":{"a":1}}},{"function":{"name":"g","arguments":null}},{"function":{"name":"h","arguments":"s"}}]},{"role":"user","content":"x"}]'
    fixed = one(spark, F.to_json(chat.repaired_messages(F.parse_json("t"))), t=raw)
    assert [c["function"]["arguments"] for c in json.loads(fixed)[0]["tool_calls"]] == ['{"a":1}', "{}", "s"] and json.loads(fixed)[1]["tool_calls"] == []
    assert one(spark, chat.content_length(F.col("t")), t='[[{"content":"ab"}],[{"content":"cdef"}]]') == 2
    assert one(spark, chat.content_length(F.col("t")), t="broken") == 0
    q = spark.createDataFrame([("i", ["a", "b", "c"])], "id string, question array<string>")
    a = spark.createDataFrame([("i", [["x"], ["y"]])], "id string, truth array<array<string>>")
    assert [r.truth for r in chat.aligned_turns(q, a).orderBy("pos").collect()] == [["x"], ["y"], []]


def test_score_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, "50%", ""), (2, "70%", ""), (3, "50%", "")], "row_ord int, acc string, Rank string")
    assert [(r.row_ord, r.Rank) for r in scores.ranked(df, "acc", "row_ord").collect()] == [(2, "1"), (1, "2"), (3, "3")]
    assert scores.ranked(df, "absent") is df
    assert [r[0] for r in spark.createDataFrame([(0.5,), (1.0,), (85.0,)], "s double").select(scores.normalised(F.col("s"))).collect()] == [50, 100, 85]
    for exp, body in (("a", "Rank,Model,Acc\n1,m,5%\n"), ("b", "Rank,Name,Acc\n1,n,7%\n2,o\n"), ("c", "")):
        (tmp_path / exp / "score").mkdir(parents=True)
        (tmp_path / exp / "score" / "s.csv").write_text(body)
    rows = scores.ranked(scores.score_tables(spark, str(tmp_path), "s.csv"), "Acc", "Experiment", "row_ord").collect()
    assert [(r.Experiment, r.Rank, r.Model, r.Acc) for r in rows] == [("b", "1", "n", "7%"), ("a", "2", "m", "5%"), ("b", "3", "o", None)]
    assert scores.chosen_subsets(" a, b ") == ["a", "b"] and len(scores.chosen_subsets(" ")) == 13
    with pytest.raises(ValueError):
        scores.category("none")


def test_provider_and_intent_rules(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "text string")

    def broken(texts):
        raise RuntimeError

    assert [r.v for r in providers.embedded(rows, "text", broken).collect()] == [None, None]
    asked = spark.createDataFrame([("1", "direct", "p"), ("2", "verify", "yes"), ("3", "verify", "no")], "id string, route string, prompt string")
    kept = providers.verified(asked, "prompt", lambda texts: ['{"valid": true}' if t == "yes" else "hm" for t in texts])
    assert {r.id for r in kept.collect()} == {"1", "2"}
    tools = spark.createDataFrame([("A", "does a", "general"), ("B", "", "Web")], "name string, description string, category string").withColumn("parameters", F.lit("{}"))
    named = providers.categorised(tools, "description", lambda texts: ['{"category": " e-mail "}' for _ in texts])
    assert {r.name: r.category for r in named.collect()} == {"A": "E-Mail", "B": "Web"}
    walk = spark.createDataFrame([("w", ["A", "B"], ["A->B:p"])], "walk string, path array<string>, keys array<string>")
    nodes = tools.select("name", "description", "category")
    made = sampling.format_skeletons(walk, nodes, edges=spark.createDataFrame([("A->B:p", "p")], "key string, parameter string"))
    prompt = intents.prompts(made, tools, "{tools}|{flow}").first().prompt
    assert prompt.startswith('{"name":"A"') and prompt.endswith("|Step 1: A -> B\n   fills p")
    reply = lambda state: lambda texts: [json.dumps({"query": "q", "initial_state": state, "final_state": {}}) for _ in texts] if not isinstance(state.get("a"), list) else ["{" for _ in texts]
    good, bad = intents.generate_intents(made, tools, "{tools}{flow}", lambda texts: ['{"query": "q", "scenario_summary": "s"}' for _ in texts])
    assert good.first().available_tools == ["A", "B"] and bad.count() == 0
    good, bad = intents.generate_intents(made, tools, "{tools}{flow}", reply({"a": [1]}))
    assert good.count() == 0 and bad.count() == 1
    state = lambda s: one(spark, intents.flat_scalars(F.parse_json("t").cast("map<string,variant>")), t=s)
    assert [state('{"a":1}'), state('{"a":[1]}'), state('{"a":null}'), state("{}")] == [True, False, False, True]


def test_sampled_skeletons(spark):
    n = 12
    edges = spark.createDataFrame([(f"t{k}", f"t{(k + d) % n}", f"t{k}->t{(k + d) % n}:p{d}", f"p{d}", 0.9) for k in range(n) for d in (1, 2)], "src string, dst string, key string, parameter string, weight double")
    nodes = spark.createDataFrame([(f"t{k}", f"tool {k}", None) for k in range(n)], "name string, description string, category string")
    tools = nodes.withColumn("parameters", F.lit("{}"))
    for mode, pattern in (("chain", "sequential"), ("neighborhood", "neighborhood_subgraph")):
        made, cover = sampling.sample_skeletons(nodes, edges, mode, 6, 3, 4, batch=4, seed=5)
        rows = made.collect()
        assert len(rows) == 6 and {r.pattern for r in rows} == {pattern}
        for r in rows:
            core = [x.name for x in r.nodes if x.role == "core"]
            assert [(e.step, e.dependency.parameter) for e in r.edges] == [(k + 1, f"p{(int(e.to[1:]) - int(e['from'][1:])) % n}") for k, e in enumerate(r.edges)]
            path = [r.edges[0]["from"], *[e.to for e in r.edges]]
            assert sorted(core) == sorted(path) and (r.meta is None) == (mode == "chain")
            if mode == "neighborhood":
                assert r.meta.core_chain_nodes == path and len(r.meta.distractor_nodes) == int(len(core) * 0.5) + 1
        if mode == "neighborhood":  # the place of a node does not tell its role
            assert any([x.role for x in r.nodes] != sorted(x.role for x in r.nodes) for r in rows)
        prompt = intents.prompts(made, tools, "{tools}|{flow}").first().prompt
        assert "\n   fills p" in prompt and prompt.startswith('{"name":"t')
        assert cover.node_visits.agg(F.sum("visits")).first()[0] >= 6
    assert sampling.sample_skeletons(nodes, edges, "unheard", 6)[0].count() == 0


def test_walk_plan_grows_by_one_join_a_step(spark):
    edges = spark.createDataFrame([("a", "b", "k", 1.0)], "src string, dst string, key string, decayed double")
    begin = spark.createDataFrame([("w", "a")], "walk string, at string")
    joins = [sampling.walk(begin, edges, 2, n)._jdf.queryExecution().analyzed().toString().count("Join ") for n in (3, 5, 8)]
    assert joins == [2, 4, 7]


def test_graph_build(spark, tmp_path):
    lines = [
        {"name": "geo", "description": "place", "parameters": {"type": "object", "properties": {"ip": {"type": "string", "description": "address"}}}},
        {"name": "ip", "description": "address", "parameters": {"type": "object", "properties": {}}},
        {"name": "far", "description": "nothing", "parameters": {"type": "object", "properties": {"x": {"type": "string"}}}},
    ]
    tools, _ = catalog.catalog(spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(lines)], "ord long, line string"))
    vector = {"geo: place": [1.0, 0.0, 0.0], "ip: address": [0.0, 1.0, 0.0], "far: nothing": [0.0, 0.0, 1.0], "Parameter ip: address": [0.0, 1.0, 1.0], "Parameter x: ": [-1.0, 0.0, 0.0]}
    embed = lambda texts: [vector[t] for t in texts]

    def model(texts):
        def one(t):
            if t.startswith("Can what"):
                return json.dumps({"valid": "First tool: ip (address)" in t and "Input: ip (address)" in t})
            if t.startswith("["):
                return json.dumps({"Net Tools": "Network"})
            assert "Finance" in t and "Tool: " in t
            return '{"category": " net tools "}' if "Tool: ip" in t or "Tool: geo" in t else "no"

        return [one(t) for t in texts]

    nodes, edges = build.build_graph(tools, embed, model, auto=0.9, category_rounds=2)
    assert {(r.name, r.category) for r in nodes.collect()} == {("geo", "Network"), ("ip", "Network")}
    assert [(r.src, r.dst, r.key, r.parameter, round(r.weight, 3)) for r in edges.collect()] == [("ip", "geo", "ip->geo:ip", "ip", 0.707)]
    nodes, edges = build.build_graph(tools, embed, auto=0.9)  # nobody verifies: dropped
    assert edges.count() == 0 and nodes.count() == 0
    nodes, edges = build.build_graph(tools, embed, auto=0.9, verify=False)
    assert {r.key for r in edges.collect()} == {"ip->geo:ip", "far->geo:ip"}

    def broken(texts):
        raise RuntimeError

    nodes, edges = build.build_graph(tools, broken)  # no vectors: all nodes stay
    assert edges.count() == 0 and nodes.count() == 3
    nodes, edges = build.build_graph(tools.limit(0), embed)
    assert edges.count() == 0 and nodes.count() == 0
    sinks.write_document(sinks.node_link_lines(tools.select("name", "description"), spark.createDataFrame([("a", "b", "k1"), ("a", "b", "k2")], "src string, dst string, key string")), str(tmp_path / "g"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "g").glob("part-*")))
    doc = json.loads(text)
    assert [n["id"] for n in doc["nodes"]] == ["far", "geo", "ip"] and [e["key"] for e in doc["links"]] == ["k1", "k2"] and doc["multigraph"]
    sinks.write_document(sinks.graphml_document(tools.select("name", "description"), spark.createDataFrame([("geo", "ip", "k<1")], "src string, dst string, key string")), str(tmp_path / "x"))
    root = ElementTree.fromstring("".join(f.read_text() for f in sorted((tmp_path / "x").glob("part-*"))))
    assert [len(root.findall(f".//{{*}}{kind}")) for kind in ("node", "edge", "key")] == [3, 1, 2]


def test_limits_replay_and_maps(spark):
    rows = spark.createDataFrame([(k, k % 2 == 0) for k in range(200)], "id int, multi_turn boolean")
    assert [r.id for r in scores.limited(rows, 3, "id").collect()] == [0, 1, 2] and scores.limited(rows, None, "id") is rows and scores.limited(rows, 0, "id") is rows
    drawn = {r.id for r in scores.subsample(rows, "id", 0.3).collect()}
    assert 30 <= len(drawn) <= 90 and drawn == {r.id for r in scores.subsample(rows.repartition(7), "id", 0.3).collect()}
    assert scores.multi_turn_only(rows).count() == 100 and scores.multi_turn_only(rows.select("id")).count() == 200
    q = spark.createDataFrame([("i", ["a", "b", "c"]), ("none", ["a"])], "id string, question array<string>")
    a = spark.createDataFrame([("i", [["x"], ["y", "z"]])], "id string, truth array<array<string>>")
    decoded = chat.replayed(q, a)
    assert [(r.id, r.decoded) for r in decoded.collect()] == [("i", [[["x"]], [["y", "z"]], [[]]])]
    assert [r.valid for r in chat.checked(decoded, a).collect()] == [True]
    assert [r.valid for r in chat.checked(decoded, a.withColumn("truth", F.reverse("truth"))).collect()] == [False]
    skeletons = spark.createDataFrame([([("a", "b")], None), ([("a", "b")], "own"), ([("c", "b")], "own"), (None, "bad")], "edges array<struct<from:string,to:string>>, id string").coalesce(1)
    assert [scores.chosen_limit(t) for t in (None, " ", "0", "-1", "7")] == [None, None, None, None, 7]
    vectors = spark.createDataFrame([("a", [1.0]), ("b", None)], "text string, v array<double>")
    assert tuple(providers.embedded_count(vectors).first()) == (2, 1)
    assert tuple(intents.success_ratio(rows.limit(3), rows.limit(1)).first()) == (4, 3, 75.0) and tuple(intents.success_ratio(rows.limit(0), rows.limit(0)).first()) == (0, 0, 0.0)
    held = {r.skeleton_id: r.edges[0][0] for r in catalog.skeleton_map(skeletons).collect()}
    assert held.pop("own") == "c" and list(held.values()) == ["a"] and next(iter(held)).startswith("skel_")
    packed = spark.createDataFrame([(0, '{"tools": "[{\\"name\\": \\"A\\"}]"}'), (1, '{"name": "B", "description": "1"}')], "ord long, line string")
    assert [r.name for r in catalog.tool_map(packed).collect()] == ["B"]


def test_simulation_goes_on_when_a_model_fails():
    def fails(*_):
        raise RuntimeError

    once = iter([("", [("1", "f", "{}")]), ("done", [])])
    turns = simulation.converse("q", ["f"], lambda q, m: "TERMINATE", lambda t, m: next(once), fails, 5, 10)
    assert [b["output"] for m in turns for b in m["blocks"] if b["type"] == "tool_result"] == ['{"status": "error", "message": "Simulation internal error"}']
    assert [m["blocks"][0]["text"] for m in simulation.converse("q", [], fails, lambda t, m: ("ok", []), fails, 5, 10)] == ["q", "ok", "TERMINATE_FAILED"]
    assert [m["blocks"][0]["text"] for m in simulation.converse("q", [], lambda q, m: "TERMINATE", fails, fails, 5, 10)] == ["q", "TERMINATE"]


def test_score_tables_of_any_width(spark, tmp_path):
    (tmp_path / "a" / "score").mkdir(parents=True)
    (tmp_path / "a" / "score" / "s.csv").write_text(",".join(f"h{k}" for k in range(70)) + "\n" + ",".join(str(k) for k in range(70)) + "\n")
    (tmp_path / "a" / "score" / "t.csv").write_text('Rank,,Overall Acc\n1,"two\nlines",50%\n')
    assert scores.score_tables(spark, str(tmp_path), "s.csv").first()["h69"] == "69"
    (row,) = scores.score_tables(spark, str(tmp_path), "t.csv").collect()
    assert row["Overall Acc"] == "50%" and row[3] == "two\nlines"
    assert scores.category("Format")[0] == "data_format_sensitivity.csv"


def test_simulation_rules():
    turns = simulation.converse("q", [], lambda q, m: "more", lambda t, m: ("ok", []), lambda n, a, m: "", 2, 10)
    assert [m["blocks"][0]["text"] for m in turns] == ["q", "ok", "more", "ok", "TERMINATE_FAILED"]
    turns = simulation.converse("q", [], lambda q, m: "I say TERMINATE.", lambda t, m: ("ok", []), lambda n, a, m: "", 5, 10)
    assert turns[-1]["blocks"][0]["text"] == "TERMINATE" and turns[-1]["role"] == "assistant" and turns[-1]["name"] == "user"


def test_policy(spark):
    rewards = spark.createDataFrame([("g", r) for r in (1.0, 0.0, 0.0, 1.0)], "g string, r double")
    assert sorted(round(r[0], 3) for r in rewards.select(policy.advantage("r", "g")).collect()) == [-0.866, -0.866, 0.866, 0.866]
    got = spark.createDataFrame([([0.0, 0.0],)], "x array<double>").select(policy.log_softmax("x")).first()[0]
    assert [round(v, 6) for v in got] == [-0.693147, -0.693147]


def test_files(spark, tmp_path):
    nodes = spark.createDataFrame([("a", ["x"])], "name string, tags array<string>")
    edges = spark.createDataFrame([("a", "a", "k<")], "src string, dst string, key string")
    sinks.save_checkpoint(str(tmp_path / "cp"), nodes=nodes)
    assert set(sinks.load_checkpoint(spark, str(tmp_path / "cp"), "nodes", "edges")) == {"nodes"}
    assert any("k&lt;" in r.line for r in sinks.graphml_lines(nodes, edges).collect())
    (tmp_path / "done.txt").write_text(" a \n\nb\na\n")
    assert {r.subset for r in catalog.done_list(spark, str(tmp_path / "done.txt")).collect()} == {"a", "b"}
    assert catalog.done_list(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "rows.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "rows.jsonl").write_text('{"a": 1}\n{bad\n{"a": 2}\n')
    assert catalog.json_rows(spark, str(tmp_path / "rows.json"), "a int").count() == catalog.json_rows(spark, str(tmp_path / "rows.jsonl"), "a int").count() == 2
    with pytest.raises(ValueError):
        catalog.json_rows(spark, str(tmp_path / "rows.jsonl"), "a int", list_only=True)
    assert [r.path.rsplit("/", 1)[1] for r in catalog.text_files(spark, str(tmp_path), ignored_dirs=["cp"], ignored_extensions=[".JSON", ".jsonl"]).collect()] == ["done.txt"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text('{"name": "A"}\n{"name": "A", "description": "2"}\nbad\n')
    query = stream_catalog(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("tools_seen").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [r.name for r in spark.table("tools_seen").collect()] == ["A"]


def test_settings():
    s = Settings.parse("# c\nA = 1\nB='on'\nC=x\n")
    assert (s.get_int("A"), s.get_bool("B"), s.get_bool("C"), s.get_int("C", 7), s.get("D")) == (1, True, False, 7, None)
