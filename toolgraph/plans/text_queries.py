"""Text, conversation, catalogue, score and policy queries over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from toolgraph.functions import policy, text
from toolgraph.functions.hashing import intent_id, json_string
from toolgraph.operators import chat, intents, providers, scores, simulation, subsample, template_tokens
from toolgraph.plans.graph_queries import table
from toolgraph.scratch import new_path
from toolgraph.sources import catalog


def chat_rows(spark, sf_dir):
    """Conversations as agent memory: the role is the actor's name and each text is one block."""
    turns = table(spark, sf_dir, "conversations")
    none = F.lit(None).cast("string")
    block = F.struct(F.lit("text").alias("type"), F.col("text"), none.alias("id"), none.alias("name"), none.alias("input"), none.alias("output"))
    memory = turns.select("conv_id", "turn", F.col("role").alias("name"), "role", F.array(block).alias("blocks"))
    line = lambda m: F.concat(m["role"], F.lit("\t"), F.coalesce(m["content"], F.lit("")))
    return chat.chat_rows(memory).select("conv_id", F.array_join(F.transform("messages", line), "\n").alias("chat"), F.size("messages").alias("n"))


def role_names(spark, sf_dir):
    tag = F.when(F.col("role") == "assistant", "gpt").when(F.col("role") == "user", "human").otherwise("observation")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.chat_role(tag).alias("role"))


def conv_tokens(spark, sf_dir):
    counted = chat.token_counts(table(spark, sf_dir, "conversations"), "text").groupBy("conv_id").agg(F.sum("n_tokens").alias("n_tokens"), F.sum(F.length("text")).cast("long").alias("n_chars"))
    use = scores.context_use(F.col("n_tokens"))
    return counted.select("conv_id", "n_tokens", "n_chars", use["over"].alias("over"), use["left"].alias("tokens_left"))


def conv_longest(spark, sf_dir):
    return chat.longest(conv_tokens(spark, sf_dir), "n_tokens", "conv_id", "conv_id").withColumn("mean_length", F.round("mean_length", 6))


def turns_json_length(spark, sf_dir):
    """Conversations as JSON text, nested in one more array for those of an even number of turns: only the first inner one counts."""
    turn = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    gathered = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    flat = F.to_json("turns")
    nested = F.concat(F.lit("["), flat, F.lit(","), flat, F.lit("]"))
    return gathered.select("conv_id", chat.content_length(F.when(F.size("turns") % 2 == 0, nested).otherwise(flat)).alias("n_chars"))


def doc_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", (F.length("text") + F.length("lang")).cast("long").alias("length"))


def doc_argmax(spark, sf_dir):
    return chat.longest(doc_lengths(spark, sf_dir), "length", "doc_id", "doc_id").withColumn("mean_length", F.round("mean_length", 6))


def length_histogram(spark, sf_dir):
    sizes = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return sizes.groupBy("turns").agg(F.count(F.lit(1)).alias("n")).orderBy("turns")


def think_insert(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("raw", F.concat("role", F.lit("\n"), "text"))
    return turns.select("conv_id", "turn", text.with_empty_think("raw").alias("text"))


def json_props(spark, sf_dir):
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "long")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(value, F.lit(-1).cast("long")).alias("k"))


def valid_part():
    return F.when(F.col("n_chars") % 2 == 0, "true").otherwise("false")


def first_json(spark, sf_dir):
    """A verdict in the middle of a reply that has the whole text of a document before and after it."""
    reply = F.concat("text", F.lit(' Answer: {"valid": '), valid_part(), F.lit("} "), "text")
    return table(spark, sf_dir, "documents").select("doc_id", text.first_json(reply).alias("json"), providers.verdict(reply).alias("valid"))


def fence_strip(spark, sf_dir):
    """A simulator's fenced reply that holds the whole text of a document."""
    reply = F.concat(F.lit('```json\n{"valid": '), valid_part(), F.lit(', "text": '), json_string("text"), F.lit("}\n```"))
    return table(spark, sf_dir, "documents").select("doc_id", text.simulated_output(reply).alias("output"))


def title_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.title(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("title"))


def pct_rank(spark, sf_dir):
    rate = F.round(F.count_if(F.col("event_type") == "click") * 100.0 / F.count(F.lit(1)), 2)
    rates = table(spark, sf_dir, "events").groupBy("user_id").agg(F.concat(rate.cast("string"), F.lit("%")).alias("Overall Acc"))
    found = scores.ranked(rates.withColumn("Rank", F.lit("")), "Overall Acc", "user_id")
    return found.select("user_id", text.percent(F.col("Overall Acc")).alias("acc"), F.col("Rank").alias("rank"))


def score_normalise(spark, sf_dir):
    """A report an item size, with brands as categories and part types as subsets; the score is a share or a percent."""
    part = table(spark, sf_dir, "part").groupBy("p_size", "p_brand", "p_type").agg(F.count(F.lit(1)).cast("int").alias("num"), F.min("p_retailprice").alias("low"))
    score = F.when(F.col("low") < 1000, F.col("low") / 1000).otherwise(F.col("low") / 100)
    subsets = part.groupBy("p_size", "p_brand").agg(F.collect_list(F.struct(F.col("p_type").alias("name"), "num", score.alias("score"))).alias("subsets"))
    reports = subsets.groupBy("p_size").agg(F.collect_list(F.struct("subsets")).alias("categories")).select(F.col("p_size").cast("string").alias("model_name"), F.array(F.struct("categories")).alias("metrics"))
    wanted = table(spark, sf_dir, "part").groupBy(F.col("p_size").cast("string").alias("size")).agg(F.min("p_type").alias("wanted"))
    asked = reports.join(wanted, F.col("model_name") == F.col("size"))
    return scores.report_lines(asked, F.col("wanted")).select("model_name", "name", "num", F.round("score", 6).alias("score"))


def accuracy(spark, sf_dir):
    found = scores.accuracy(table(spark, sf_dir, "labels").withColumn("ok", F.col("quality") == 1), "ok", "doc_id")
    return found.select("total", "passed", F.round("accuracy", 6).alias("accuracy"), F.size("failed").alias("n_failed"), F.md5(F.array_join(F.transform("failed", lambda x: x.cast("string")), ",")).alias("failed_md5"))


def resume_anti(spark, sf_dir):
    return scores.remaining(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


def truth_align(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter("role IN ('user', 'assistant')")
    held = lambda role: F.transform(F.filter(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: t["role"] == role), lambda t: t["text"])
    both = turns.groupBy(F.col("conv_id").alias("id")).agg(held("user").alias("question"), F.transform(held("assistant"), lambda t: F.array(t)).alias("truth"))
    found = chat.aligned_turns(both.select("id", "question"), both.select("id", "truth"))
    return found.select("id", "pos", F.md5("question").alias("question_md5"), F.md5(F.array_join("truth", "|")).alias("truth_md5"), F.size("truth").alias("n_truth"))


def advantage(spark, sf_dir):
    gain = F.coalesce(policy.advantage("value", "user_id"), F.lit(0.0))
    return table(spark, sf_dir, "events").select("event_id", F.round(gain, 6).alias("advantage"))


def kl_policy(spark, sf_dir):
    """Token log probabilities from events: old is -value/100, new and reference are shifted by the event id's last digits."""
    shift = lambda m: (F.pmod("event_id", F.lit(m)) - m / 2) / 100.0
    old = -F.col("value") / 100.0
    rows = table(spark, sf_dir, "events").select("user_id", old.alias("old"), (old + shift(7)).alias("new"), (old + shift(5)).alias("ref"), F.when(F.col("event_type") != "view", 1).otherwise(0).alias("mask"))
    total = policy.clipped_loss("new", "old", F.lit(1.0)) + 0.04 * policy.divergence("new", "ref")
    return rows.withColumn("total", total).groupBy("user_id").agg(F.round(policy.masked_mean("total", "mask"), 6).alias("loss"))


def intent_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", intent_id("text", F.array("source", "lang"), F.array(F.lit("ip"), F.lit("city")), F.array("lang")).alias("id"))


def part_lines(spark, sf_dir):
    """Tools as JSON lines: one a part, named by brand and type so that names repeat; large sizes come in a function envelope."""
    number = F.struct(F.lit("number").alias("type"), F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("description"))
    tool = F.struct(F.concat_ws("_", "p_brand", "p_type").alias("name"), F.col("p_name").alias("description"), F.struct(F.lit("object").alias("type"), F.struct(number.alias("size")).alias("properties"), F.array(F.lit("size")).alias("required")).alias("parameters"))
    plain, enveloped = F.to_json(tool), F.to_json(F.struct(F.lit("function").alias("type"), tool.alias("function")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.when(F.col("p_size") > 25, enveloped).otherwise(plain).alias("line"))


def catalog_tools(spark, sf_dir):
    tools, _ = catalog.catalog(part_lines(spark, sf_dir))
    return tools.select("ord", "name", "description", "category", F.array_join("parameters.required", ",").alias("required"))


def catalog_last(spark, sf_dir):
    return catalog.tool_map(part_lines(spark, sf_dir)).select("name", "description")


def tool_texts(spark, sf_dir):
    tools, _ = catalog.catalog(part_lines(spark, sf_dir))
    made = catalog.producer_texts(tools).select(F.col("producer").alias("name"), F.lit("").alias("param"), "text")
    return made.union(catalog.consumer_texts(tools).select("consumer", "param", "text"))


def function_tools(spark, sf_dir):
    tools, _ = catalog.catalog(part_lines(spark, sf_dir))
    return chat.function_tools(tools).select("type", F.col("function.name").alias("name"), F.col("function.description").alias("description"), F.array_join("function.parameters.required", ",").alias("required"))


def consolidated_categories(spark, sf_dir):
    """Part types as categories, of which the mapping knows those of brand 1 parts."""
    part = table(spark, sf_dir, "part")
    tools = part.select(F.col("p_partkey").alias("name"), F.col("p_type").alias("category"))
    mapping = part.groupBy(F.col("p_type").alias("raw")).agg(F.min("p_brand").alias("master")).filter(F.col("raw").contains("STEEL") | F.col("raw").contains("steel"))
    return providers.consolidated(tools, mapping)


def category_pool(spark, sf_dir):
    return providers.category_pool(table(spark, sf_dir, "part").select(F.col("p_type").alias("category")))


def embedded_tools(spark, sf_dir):
    """Vectors of a deterministic stub provider for every tool text, written as bytes."""
    found = providers.embedded(tool_texts(spark, sf_dir), "text", providers.stub_embedder(8))
    return found.select("name", "param", F.array_join(F.transform("v", lambda x: F.round((x + 1) * 127.5).cast("int").cast("string")), ",").alias("v"))


def exact_subsample(spark, sf_dir):
    """500 documents of all, drawn by a hash of their id."""
    drawn = subsample.exactly(table(spark, sf_dir, "documents"), "doc_id", 500)
    return drawn.select("doc_id", F.md5("text").alias("text_md5"))


def load_counts(spark, sf_dir):
    """Parts written as JSON lines, some of them cut and some followed by a blank line, loaded as a catalogue: what the load saw."""
    tool = F.to_json(F.struct(F.concat_ws("_", "p_brand", "p_type").alias("name"), F.col("p_name").alias("description")))
    line = F.when(F.col("p_partkey") % 7 == 0, F.substring(tool, 1, 20)).otherwise(tool)
    lines = table(spark, sf_dir, "part").select(F.explode(F.when(F.col("p_partkey") % 50 == 0, F.array(line, F.lit("  "))).otherwise(F.array(line))).alias("line"))
    path = new_path(spark, "catalogue-lines")
    lines.write.text(path)
    _, seen = catalog.load_catalog(spark, path)
    return spark.createDataFrame([seen], ", ".join(f"{k} long" for k in ("lines", "blank", "unreadable", "records", "tools")))


def grounded_states(spark, sf_dir):
    """For each conversation a state of a word of its first turn, a digit of its id and, for some, a word from elsewhere; the digit is a chained parameter of odd ones."""
    first = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("query"))
    word = F.regexp_extract("query", r"[A-Za-z]+", 0)
    state = F.concat(F.lit('{"word": "'), word, F.lit('", "digit": '), (F.col("conv_id") % 10).cast("string"), F.when(F.col("conv_id") % 3 == 0, F.lit(', "city": "Xyzzy", "more": [1]')).otherwise(F.lit("")), F.lit("}"))
    chained = F.when(F.col("conv_id") % 2 == 1, F.array(F.lit("digit")))
    held = F.when(F.col("conv_id") % 5 == 0, F.concat("query", F.lit(" "), (F.col("conv_id") % 10).cast("string"))).otherwise(F.col("query"))
    fits = intents.grounded(held, F.try_parse_json(state).cast("map<string,variant>"), chained)
    return first.select("conv_id", fits["said"].alias("said"), fits["unchained"].alias("unchained"))


def template_token_counts(spark, sf_dir):
    """Conversations as JSON text: plain, nested in one more array, without roles (the template fails), and cut (no JSON)."""
    turn = F.struct("turn", F.col("role"), F.col("text").alias("content"))
    gathered = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    plain = F.to_json("turns")
    bare = F.to_json(F.transform("turns", lambda t: F.struct(t["content"].alias("content"))))
    kind = F.col("conv_id") % 4
    text_ = F.when(kind == 0, plain).when(kind == 1, F.concat(F.lit("["), plain, F.lit("]"))).when(kind == 2, bare).otherwise(F.substring(plain, 1, 15))
    return gathered.select("conv_id", template_tokens.template_tokens(text_).alias("n_tokens"))


def echo_user(query, memory):
    return simulation.STOP if len(memory) > 4 else "go on"


def echo_assistant(tools, memory):
    last = memory[-1]["blocks"][0]
    return ("", [("c1", tools[0], "{}")]) if tools and last["type"] == "text" else ("done: " + (last["output"] or ""), [])


def echo_tool(name, arguments, memory):
    return f'{{"tool": "{name}"}}'


def simulated_chats(spark, sf_dir):
    """A simulated conversation for each real one: its first user turn asks, its role names are the tools."""
    asked = table(spark, sf_dir, "conversations").filter("role = 'user'").groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.min_by("text", "turn").alias("query")).withColumn("tools", F.array(F.lit("search")))
    memory = simulation.simulate(asked, echo_user, echo_assistant, echo_tool)
    line = lambda m: F.concat(m["role"], F.lit("\t"), F.coalesce(m["content"], F.lit("")))
    return chat.chat_rows(memory).select(F.col("conv_id").cast("long").alias("conv_id"), F.array_join(F.transform("messages", line), "\n").alias("chat"))


QUERIES = {f.__name__: f for f in (
    chat_rows, role_names, conv_tokens, conv_longest, turns_json_length, doc_lengths, doc_argmax, length_histogram, think_insert, json_props, first_json, fence_strip,
    title_words, pct_rank, score_normalise, accuracy, resume_anti, truth_align, advantage, kl_policy, intent_ids, catalog_tools, catalog_last, tool_texts,
    function_tools, consolidated_categories, category_pool, embedded_tools, simulated_chats, exact_subsample, load_counts, grounded_states, template_token_counts,
)}

ROLE_SQL = "CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' ELSE role END"
CONV_TOKENS = r"t AS (SELECT conv_id, CAST(sum(len(regexp_extract_all(text, '\S+'))) AS BIGINT) AS n_tokens, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY 1)"
TOOLS = """l AS (SELECT p_partkey AS ord, p_brand || '_' || p_type AS name, p_name AS description, p_size FROM part),
f AS (SELECT name, min(ord) AS ord, arg_min(description, ord) AS description, arg_min(p_size, ord) AS p_size FROM l GROUP BY name)"""
ESCAPES = {92: "chr(92) || chr(92)", 34: "chr(92) || '\"'", 10: "chr(92) || 'n'", 13: "chr(92) || 'r'", 9: "chr(92) || 't'", 8: "chr(92) || 'b'", 12: "chr(92) || 'f'"}
ESCAPES |= {c: f"chr(92) || 'u{c:04x}'" for c in range(1, 32) if c not in ESCAPES}
#: a document's whole text as a JSON string
QUOTED = f"""'"' || {reduce(lambda sql, c: f"replace({sql}, chr({c}), {ESCAPES[c]})", ESCAPES, "text")} || '"'"""
DOC_VALID = "CASE WHEN n_chars % 2 = 0 THEN 'true' ELSE 'false' END"
ORACLE = {
    "chat_rows": f"SELECT conv_id, string_agg({ROLE_SQL} || chr(9) || text, chr(10) ORDER BY turn) AS chat, CAST(count(*) AS INT) AS n FROM conversations GROUP BY conv_id",
    "role_names": "SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'assistant' WHEN 'user' THEN 'user' ELSE 'tool_response' END AS role FROM conversations",
    "conv_tokens": f"WITH {CONV_TOKENS} SELECT *, n_tokens > 32000 AS over, 32000 - n_tokens AS tokens_left FROM t",
    "conv_longest": f"WITH {CONV_TOKENS} SELECT arg_max(conv_id, (n_tokens, -conv_id)) AS conv_id, max(n_tokens) AS max_length, round(avg(n_tokens), 6) AS mean_length, count(*) AS n FROM t",
    "turns_json_length": "SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY 1",
    "doc_lengths": "SELECT doc_id, CAST(length(text) + length(lang) AS BIGINT) AS length FROM documents",
    "doc_argmax": "WITH t AS (SELECT doc_id, CAST(length(text) + length(lang) AS BIGINT) AS l FROM documents) SELECT arg_max(doc_id, (l, -doc_id)) AS doc_id, max(l) AS max_length, round(avg(l), 6) AS mean_length, count(l) AS n FROM t",
    "length_histogram": "SELECT turns, count(*) AS n FROM (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1) GROUP BY 1",
    "think_insert": "SELECT conv_id, turn, replace(role || chr(10) || text, 'assistant' || chr(10), 'assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)) AS text FROM conversations",
    "json_props": "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), -1) AS k FROM events",
    "first_json": f"""WITH r AS (SELECT doc_id, regexp_extract(text || ' Answer: {{"valid": ' || {DOC_VALID} || '}} ' || text, '(?s)\\{{.*?\\}}') AS inner_json FROM documents),
j AS (SELECT doc_id, CASE WHEN json_valid(inner_json) THEN inner_json END AS json FROM r) SELECT doc_id, json, coalesce(json_extract_string(json, '$.valid') = 'true', FALSE) AS valid FROM j""",
    "fence_strip": f"""SELECT doc_id, trim(replace('{{"valid": ' || {DOC_VALID} || ', "text": ' || {QUOTED} || '}}', '```', ''), ' ') AS output FROM documents""",
    "title_words": "SELECT p_partkey, array_to_string(list_transform(string_split(p_type, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part",
    "pct_rank": """WITH r AS (SELECT user_id, round(count(*) FILTER (event_type = 'click') * 100.0::DOUBLE / count(*), 2) AS acc FROM events GROUP BY 1)
SELECT user_id, acc, CAST(row_number() OVER (ORDER BY acc DESC, user_id) AS VARCHAR) AS rank FROM r""",
    "score_normalise": """WITH w AS (SELECT p_size, min(p_type) AS wanted FROM part GROUP BY 1),
s AS (SELECT p.p_size, p_brand, p_type, CAST(count(*) AS INT) AS num, min(p_retailprice) AS low FROM part p JOIN w ON w.p_size = p.p_size AND wanted = p_type GROUP BY ALL),
v AS (SELECT *, CASE WHEN low < 1000 THEN low / 1000 ELSE low / 100 END AS score FROM s)
SELECT CAST(p_size AS VARCHAR) AS model_name, p_type AS name, num, round(CASE WHEN score <= 1 THEN score * 100 ELSE score END, 6) AS score FROM v""",
    "accuracy": """SELECT count(*) AS total, count(*) FILTER (quality = 1) AS passed, round(count(*) FILTER (quality = 1) * 100.0::DOUBLE / count(*), 6) AS accuracy,
CAST(count(*) FILTER (quality IS DISTINCT FROM 1) AS INT) AS n_failed, md5(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FILTER (quality IS DISTINCT FROM 1)) AS failed_md5 FROM labels""",
    "resume_anti": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "truth_align": """WITH n AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS pos FROM conversations WHERE role IN ('user', 'assistant'))
SELECT q.conv_id AS id, CAST(q.pos AS INT) AS pos, md5(q.text) AS question_md5, md5(coalesce(a.text, '')) AS truth_md5, CAST(a.conv_id IS NOT NULL AS INT) AS n_truth
FROM n q LEFT JOIN n a ON a.conv_id = q.conv_id AND a.pos = q.pos AND a.role = 'assistant' WHERE q.role = 'user'""",
    "advantage": "SELECT event_id, round(coalesce((value - avg(value) OVER (PARTITION BY user_id)) / (stddev_samp(value) OVER (PARTITION BY user_id) + 1e-8), 0), 6) AS advantage FROM events",
    "kl_policy": """WITH b AS (SELECT user_id, -value / 100.0::DOUBLE AS old, (event_id % 7 - 3.5::DOUBLE) / 100.0::DOUBLE AS d7, (event_id % 5 - 2.5::DOUBLE) / 100.0::DOUBLE AS d5, CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END AS mask FROM events),
t AS (SELECT user_id, mask, -least(exp(d7), least(greatest(exp(d7), 0.8::DOUBLE), 1.2::DOUBLE)) + 0.04::DOUBLE * (exp(d5 - d7) - (d5 - d7) - 1) AS total FROM b)
SELECT user_id, round(sum(total * mask) / nullif(sum(mask), 0), 6) AS loss FROM t GROUP BY 1""",
    "intent_ids": f"""SELECT doc_id, md5('{{"final_keys": ["' || lang || '"], "init_keys": ["city", "ip"], "q": ' || {QUOTED} || ', "tools": ["' || least(lang, source) || '", "' || greatest(lang, source) || '"]}}') AS id FROM documents""",
    "catalog_tools": f"WITH {TOOLS} SELECT ord, name, description, 'general' AS category, 'size' AS required FROM f",
    "catalog_last": f"WITH {TOOLS} SELECT name, arg_max(description, ord) AS description FROM l GROUP BY name",
    "tool_texts": f"WITH {TOOLS} SELECT name, '' AS param, name || ': ' || description AS text FROM f UNION ALL SELECT name, 'size', 'Parameter size: size ' || p_size FROM f",
    "function_tools": f"WITH {TOOLS} SELECT 'function' AS type, name, description, 'size' AS required FROM f",
    "consolidated_categories": """WITH m AS (SELECT p_type AS raw, min(p_brand) AS master FROM part WHERE p_type LIKE '%STEEL%' OR p_type LIKE '%steel%' GROUP BY 1)
SELECT p_partkey AS name, coalesce(master, p_type) AS category FROM part LEFT JOIN m ON raw = p_type""",
    "category_pool": f"SELECT DISTINCT category FROM (SELECT p_type AS category FROM part UNION ALL SELECT unnest({providers.CATEGORY_POOL}))",
    "embedded_tools": f"""WITH {TOOLS}, t AS (SELECT name, '' AS param, name || ': ' || description AS text FROM f UNION ALL SELECT name, 'size', 'Parameter size: size ' || p_size FROM f)
SELECT name, param, array_to_string(list_transform(range(8), lambda k: CAST(('0x' || substr(md5(text), CAST(2 * k + 1 AS INT), 2)) AS INT)), ',') AS v FROM t""",
    "exact_subsample": "SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)) LIMIT 500",
    "load_counts": """SELECT count(*) + count(*) FILTER (p_partkey % 50 = 0) AS lines, count(*) FILTER (p_partkey % 50 = 0) AS blank, count(*) FILTER (p_partkey % 7 = 0) AS unreadable,
count(*) FILTER (p_partkey % 7 <> 0) AS records, count(DISTINCT p_brand || '_' || p_type) FILTER (p_partkey % 7 <> 0) AS tools FROM part""",
    "grounded_states": r"""WITH f AS (SELECT conv_id, arg_min(text, turn) AS query FROM conversations GROUP BY 1)
SELECT conv_id, contains(query, regexp_extract(query, '[A-Za-z]+')) AND conv_id % 3 <> 0 AND (conv_id % 5 = 0 OR contains(query, CAST(conv_id % 10 AS VARCHAR))) AS said, conv_id % 2 = 0 AS unchained FROM f""",
    "template_token_counts": r"""WITH g AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS whole, string_agg(text, '' ORDER BY turn) AS bare FROM conversations GROUP BY 1)
SELECT conv_id, CAST(CASE conv_id % 4 WHEN 3 THEN 0 WHEN 2 THEN len(regexp_extract_all(bare, '\S+')) ELSE len(regexp_extract_all(whole, '\S+')) END AS BIGINT) AS n_tokens FROM g""",
    "simulated_chats": """WITH q AS (SELECT conv_id, arg_min(text, turn) AS query FROM conversations WHERE role = 'user' GROUP BY 1)
SELECT conv_id, 'user' || chr(9) || query || chr(10) || 'assistant' || chr(9) || chr(10) || 'tool' || chr(9) || '{"tool": "search"}' || chr(10) || 'assistant' || chr(9) || 'done: {"tool": "search"}'
 || chr(10) || 'user' || chr(9) || 'go on' || chr(10) || 'assistant' || chr(9) || chr(10) || 'tool' || chr(9) || '{"tool": "search"}' || chr(10) || 'assistant' || chr(9) || 'done: {"tool": "search"}' AS chat FROM q""",
}
