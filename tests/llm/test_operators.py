"""The numbered operators against brute force, exact round trips and their defined results for odd rows."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle import connect, same
from toolgraph.llm import bpe, exact_dedup, language_id, lattice_dedup, minhash, mixing, passages, preference, queries, shingles, token_blocks, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, bucket string"
WORDS = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]


def words(seed, n):
    rng = np.random.default_rng(seed)
    return [WORDS[k] + str(k % 7) for k in rng.integers(0, len(WORDS), n)]


def odd_docs(spark):
    base = " ".join(words(1, 80))
    rows = [
        (1, base, "en", "a", 1, "x", "y"), (2, base.upper(), "en", "a", 1, None, None), (3, base + " tail", "en", None, 1, None, None), (4, None, None, "b", None, None, None),
        (5, "", "fr", "b", 0, None, None), (6, "   \n", "fr", "b", 0, None, None), (7, "12 34 !!", None, "a", 0, None, None), (8, "Ünïcode ΣΑΣ <|endoftext|> x\x1cy 日本語", "de", "c", 1, None, None),
        (None, "no id", "en", "a", 1, None, None), (9, " ".join(words(2, 30000)), "de", "c", 1, None, None), (10, "one", "en", "a", 3, None, None), (10, "one", "en", "a", 3, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), queries.ORACLE[name], sf_dir)


@pytest.mark.parametrize("run", [
    exact_dedup.digest_groups, minhash.near_duplicate_classes, mixing.mix, mixing.mixed_documents, passages.repeated_passages, exact_dedup.drop_exact_copies,
    lambda d: bpe.token_digests(d, PATH), lambda d: language_id.identify(d, language_id.train(d)), minhash.drop_near_duplicates,
    lambda d: toxicity.predict(d, toxicity.train(d, d.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")))),
])
def test_empty_and_odd_rows_do_not_crash(spark, run):
    docs = odd_docs(spark)
    assert run(docs.limit(0)).count() == 0
    assert run(docs).count() > 0


def test_op2_and_op6_equal_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    docs = odd_docs(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    for r in bpe.token_digests(docs, PATH).collect():
        packed = np.array(ids[r.doc_id], "<u4").tobytes()
        decoded = library.decode(ids[r.doc_id], skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    token_blocks.write_blocks(docs, PATH, str(tmp_path / "blocks"), segment_ids=1000)
    at = 0
    for r in sorted(token_blocks.read_blocks(spark, str(tmp_path / "blocks")).collect()):
        packed = np.array([*ids[r.doc_id], 1], "<u4").tobytes()
        assert (r.start, r.n_tokens, zlib.crc32(bytes(r.token_ids))) == (at, len(packed) // 4, zlib.crc32(packed))
        at += r.n_tokens


@pytest.mark.parametrize("ids", [[], [5], [0] * 256, list(range(700)), [1] * 255 + [2**32 - 1], list(np.random.default_rng(0).integers(0, 2**32, 1000))])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    packed = token_blocks.pack(ids)
    assert (token_blocks.unpack(packed) == ids).all()
    assert (token_blocks.unpack(packed, 200, 300) == ids[200:300]).all()


def test_op1_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op1_language_id"](spark, sf_dir).filter("held_out").join(docs, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    odd = {r.doc_id: r for r in language_id.identify(odd_docs(spark), language_id.train(odd_docs(spark))).collect()}
    assert all(odd[k].lang_pred == "und" and odd[k].score == 0 and odd[k].rejected for k in (4, 5, 6, 7))


def test_op1_learns_every_language_and_rejects_in_each(spark):
    """Languages of three and of 40 documents; ids are such that the rare one's are all in the part that is set apart."""
    ids = [r.id for r in spark.range(4000).filter(~language_id.held_out_id("id")).withColumn("p", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5))).filter("p = 0").limit(3).collect()]
    rng = np.random.default_rng(8)
    word = lambda letters: "".join(rng.choice(list(letters), rng.integers(2, 7)))
    text = lambda letters: " ".join(word(letters) for _ in range(60))
    rows = [(i, text("qxzjkw"), "rare") for i in ids] + [(5000 + k, text("aeiount"), "en") for k in range(50)] + [(9000 + k, text("srldmp"), "fr") for k in range(50)]
    rows += [rows[0], (None, text("aeiount"), "en"), (1, None, "en")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(train)
    assert model.langs == ["en", "fr", "rare"] and all(limit != (0.0, 1.0, 1.0) for limit in model.limits.values())
    asked = spark.createDataFrame([(1, text("qxzjkw")), (2, text("aeiount")), (3, text("srldmp")), (4, text("вгдшщ")), (4, text("вгдшщ"))], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in language_id.identify(asked, model).orderBy("doc_id").collect()]
    assert got[:3] == [(1, "rare", False), (2, "en", False), (3, "fr", False)] and got[3] == got[4] and got[3][2]


def test_op1_models_are_probability_distributions():
    """What follows a context sums to one, and array look-ups agree with the recursion written out."""
    text = language_id.letters_only("the cat sat on the mat and the rat ate the hat that sat there " * 3)
    t, order = "   " + text, 4
    counts = {}
    for k in range(len(t) - order + 1):
        counts[t[k : k + order]] = counts.get(t[k : k + order], 0) + 1
    model = language_id.KneserNey(dict(counts), order)
    alphabet = sorted({g[-1] for g in counts})
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = {}
        for g in levels[n + 1]:
            levels[n][g[1:]] = levels[n].get(g[1:], 0) + 1

    def p(c, context):
        n = len(context) + 1
        below = p(c, context[1:]) if n > 1 else 1 / (len(alphabet) + 1)
        level = levels[n]
        once, twice = (sum(v == k for v in level.values()) for k in (1, 2))
        d = min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))
        seen = [v for g, v in level.items() if g[:-1] == context]
        return max(level.get(context + c, 0) - d, 0) / sum(seen) + d * len(seen) / sum(seen) * below if seen else below

    for context in sorted({g[:-1] for g in counts})[:25]:
        texts = [context + c for c in [*alphabet, "\u0416"]]  # the last stands for all unseen ones
        points = [np.frombuffer(x.encode("utf-32-le"), "<u4").astype(np.uint64) for x in texts]
        hashes = [np.array([language_id.gram_hashes(q, n)[-1] for q in points]) for n in range(1, order + 1)]
        before = [np.array([language_id.gram_hashes(q, max(n, 1))[-2] for q in points]) for n in range(order)]
        found = np.exp(model.log_probabilities(hashes, before).astype(float))
        assert np.allclose(found, [p(c, context) for c in [*alphabet, "\u0416"]], rtol=1e-4)
        assert abs(found.sum() - 1) < 1e-4


def test_op3_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (0, 1):
        for _ in range(40):
            center = rng.normal(size=16)
            for _ in range(rng.integers(1, 5)):
                rows.append((k, (center + rng.normal(size=16) * 0.2).tolist(), label))
                k += 1
    rows += [(k, None, 0), (k + 1, [0.0] * 16, 0), (k + 2, [float("nan")] * 16, 0), (k + 3, rows[0][1], None), (k + 4, rows[0][1], 0), (k + 5, [None] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice_dedup.lattice_links(df).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, g in rows if v and g is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: g for i, _, g in rows}
    links = {i: {j for j in unit if j != i and label[i] == label[j] and unit[i] @ unit[j] >= 0.93} if i in unit else set() for i in label}
    for i in label:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        assert got[i] == (len(links[i]), min(reach), min(reach) == i)
    assert lattice_dedup.lattice_links(df.limit(0)).count() == 0


def test_op3_mixed_lengths_labels_of_any_type_and_repeated_ids(spark):
    v = [float(k) for k in range(1, 9)]
    near = [1.05, *v[1:]]
    rows = [(1, v, "1.2", 0), (2, v, "1.7", 0), (3, near, "1.2", 0), (4, v[:7], "1.2", 0), (5, v, "x", 0), (5, v, "x", 1), (5, near, "x", 2), (None, v, "x", 0), (9, [-x for x in v], "x", 0)]
    for kind in ("array<double>", "array<float>"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label string, cell int")
        got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in lattice_dedup.lattice_links(df).collect())
        assert got == [(0, 0, 0), (1, 1, 1), (2, 0, 2), (3, 1, 1), (4, 0, 4), (5, 2, 5), (5, 2, 5), (5, 2, 5), (9, 0, 9)]
    numbers = spark.createDataFrame([(1, v, 1.2), (2, v, 1.7)], "vec_id long, embedding array<double>, label double")
    assert {r.n_links for r in lattice_dedup.lattice_links(numbers).collect()} == {0}


def test_op3_cells_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "BLOCK", 16)
    rng = np.random.default_rng(4)
    center = rng.normal(size=12)
    rows = [(k, (center + rng.normal(size=12) * 0.25).tolist(), 7) for k in range(150)]
    unit = np.array([v / np.linalg.norm(v) for _, v, _ in rows])
    near = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in lattice_dedup.lattice_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {k: int(n) for k, n in enumerate(near)}


def test_op3_plans_grow_slowly():
    tables = [lattice_dedup.plan(10**k, 64)[0] for k in (3, 5, 7, 9)]
    assert tables == sorted(tables) and tables[-1] <= 80


def test_op4_odd_rows(spark):
    rows = [(1, 0, "user", "q", 9), (1, 1, "assistant", "long answer", 9), (2, 0, "user", "q", 9), (2, 1, "assistant", "no", 9), (3, 0, None, None, 9), (None, 0, "user", "q", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spoken int")
    got = {r.conv_id: r for r in preference.format_pairs(preference.preference_pairs(df)).collect()}
    assert set(got) == {1, 2, 3} and got[2].chosen_id == 1 and got[2].prefix_turns == 1
    assert got[2].prompt == "<|im_start|>user\nq<|im_end|>\n" and got[2].rejected_completion == "<|im_start|>assistant\nno<|im_end|>\n"
    (span,) = got[2].rejected_mask
    assert got[2].rejected_completion[span.start : span.end] == "no<|im_end|>\n"
    assert preference.preference_pairs(df.limit(0)).count() == 0


def test_op5_finds_fuzzy_passages_and_nothing_else(spark):
    shared = words(9, 70)
    bent = list(shared)
    bent[35] = "changed"
    del bent[50]
    rows = [(1, " ".join(words(11, 200) + shared + words(12, 100))), (2, " ".join(words(13, 90) + bent + words(14, 50))), (3, " ".join(words(15, 300))), (4, " ".join(words(16, 40) + shared)), (5, None)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} | {r.partner_id for r in found} == {1, 2, 4}
    hit = next(r for r in found if (r.partner_id, r.doc_id) == (1, 4))
    assert hit.partner_start <= 202 and hit.partner_end >= 268 and hit.similarity >= 0.8


def test_op8_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for group in range(12):
        base = words(100 + group, 150)
        for _ in range(4):
            text = list(base)
            for _ in range(rng.integers(0, 6)):
                text[rng.integers(0, len(text))] = f"x{rng.integers(0, 10**6)}"
            rows.append((k, " ".join(text)))
            k += 1
    rows += [(k, rows[0][1].upper()), (k + 1, "short text"), (k + 2, "short text"), (k + 3, None), (k + 4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n, counts = minhash.document_frequencies(df)
    idf = minhash.inverse_frequencies(n, counts)
    sets = {i: np.repeat(*next(minhash.document_shingles(pa.array([t], pa.string()), 5))) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        return i if parent[i] == i else top(parent[i])

    for a in sets:
        for b in sets:
            if a < b and len(sets[a]) and len(sets[b]) and minhash.weighted_jaccard(sets[a], sets[b], idf) >= 0.8:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.doc_id: r.class_id for r in minhash.near_duplicate_classes(df).collect()}
    assert got == {i: top(i) for i in sets}


def test_op9_meets_targets_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert all(r.taken <= 2 * r.size and all(0 <= p <= 1 for p in r.positions) for r in rows)
    by_target = {}
    for r in rows:
        by_target.setdefault((r.target, r.source_size), []).append(r)
    for (target, source_size), own in by_target.items():
        assert target <= 2 * source_size + 1e-6 and abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)


def test_op10_learns(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = queries.QUERIES["op10_toxicity"](spark, sf_dir).withColumnRenamed("toxic", "said").join(labels, "doc_id")
    assert found.filter("said = (toxic = 1)").count() >= 0.9 * found.count()
    odd = odd_docs(spark)
    rows = toxicity.predict(odd, None).collect()
    assert not any(r.toxic for r in rows) and len(rows) == odd.count()


def test_op10_beats_saying_no_and_trains_each_category_on_its_own_labels(spark):
    rng = np.random.default_rng(10)
    toxic = rng.random(240) < 0.25
    plain = words(70, 400)
    texts = [" ".join([*rng.choice(plain, 40), *(["vile", "wretch"] if t else [])]) for t in toxic]
    docs = spark.createDataFrame([*enumerate(texts), (999, None)], "doc_id long, text string")
    # quality is null for every second row and toxic for every third; one label is doubled, one has no document
    marks = [(k, None if k % 2 else 1, None if k % 3 == 0 else int(t)) for k, t in enumerate(toxic[:160])]
    labels = spark.createDataFrame([*marks, marks[1], (5000, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.predict(docs, toxicity.train(docs, labels)).collect()}
    held = range(160, 240)
    hits = sum(found[k].toxic and toxic[k] for k in held)
    f1 = 2 * hits / (sum(found[k].toxic for k in held) + sum(toxic[k] for k in held))
    assert f1 > 0.95 and not found[999].toxic and not any(found[k].low_quality for k in held)
    only = labels.withColumn("quality", F.lit(None).cast("int"))
    again = {r.doc_id: r.toxic for r in toxicity.predict(docs, toxicity.train(docs, only)).collect()}
    assert sum(again[k] == bool(toxic[k]) for k in held) >= 76
    one_class = labels.withColumn("toxic", F.lit(0))
    assert not any(r.toxic for r in toxicity.predict(docs, toxicity.train(docs, one_class)).collect())


def test_shingles_do_not_depend_on_the_batch():
    texts = ["Hello, big World of words here", None, "", "a b", "x " * 50]
    together, starts = shingles.word_hashes(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        alone, _ = shingles.word_hashes(pa.array([t], pa.string()))
        assert (together[starts[k] : starts[k + 1]] == alone).all()


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = corpus_pipeline.keep_known_languages(spark, docs, sf_dir)
    assert known.columns == docs.columns and known.count() >= 0.95 * docs.count()
    unique = corpus_pipeline.drop_exact_copies(spark, docs, sf_dir)
    count = connect(sf_dir).execute("SELECT count(DISTINCT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) FROM documents").fetchall()[0][0]
    assert unique.columns == docs.columns and unique.count() == count
    mixed = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    taken = {r.doc_id: r.repeats for r in mixing.mix(docs).collect()}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in taken.items() if n}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "mixing to target weights", "BPE encoding and decoding"]
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
