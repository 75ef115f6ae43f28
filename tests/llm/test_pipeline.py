"""The pipeline as a plain Python program over the smallest tables, and stages on rows with expected values."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import words
from tests.oracle import connect
from toolgraph.llm import exact_dedup, language_id, lattice_dedup, minhash, mixing, token_blocks

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def components(links, nodes):
    low = {n: n for n in nodes}

    def top(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        low[b] = a
    return {n: top(n) for n in nodes}


def near_classes(texts):
    """Classes of texts by all pairs, from shingles and document frequencies counted in plain dictionaries."""
    sets = {d: dict(zip(*(v.tolist() for v in next(minhash.document_shingles(pa.array([t], pa.string()), 5))), strict=True)) for d, t in texts.items()}
    held = Counter(s for own in sets.values() for s in own)
    weight = {d: {s: n * np.log1p(len(texts) / held[s]) for s, n in own.items()} for d, own in sets.items()}
    total = {d: sum(w.values()) for d, w in weight.items()}
    holders = {}
    for d, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(d)
    pairs = {(a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    links = []
    for a, b in pairs:
        both = sum(min(w, weight[b].get(s, 0.0)) for s, w in weight[a].items())
        if both / (total[a] + total[b] - both) >= 0.8:
            links.append((a, b))
    return components(links, texts)


def test_pipeline_equals_a_plain_program(spark, sf_dir):
    from tokenizers import Tokenizer

    table = connect(sf_dir).execute(f"SELECT {', '.join(COLUMNS)} FROM documents").fetchall()
    docs = {r[0]: r for r in table}
    assert len(docs) == len(table)
    identifier = language_id.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    known = [d for d, (*_, rejected) in zip(docs, identifier.predict([r[1] for r in docs.values()]), strict=True) if not rejected]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    winners = {}
    for d in known:
        key = (docs[d][1] or "").translate(lower)
        winners[key] = max(winners.get(key, d), d)
    unique = sorted(winners.values())
    classes = near_classes({d: docs[d][1] for d in unique})
    kept = [d for d in unique if classes[d] == d]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(COLUMNS, docs[d], strict=True)) for d in kept]))
    taken = {d: n // size if size else 0 for d, size, n in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    wanted = Counter()
    for d in kept:
        ids = library.encode(docs[d][1] or "", add_special_tokens=False).ids
        packed, decoded = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        if taken[d]:
            wanted[d, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += taken[d]
    assert len(docs) >= len(known) > len(unique) > len(kept) > 0
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == wanted


def test_op7_values_of_null_and_repeated_ids(spark):
    rows = [(1, "Same", 0), (1, "same", 1), (4, "SAME", 2), (None, "x", 3), (None, "x", 4), (2, None, 5), (3, "", 6), (5, "straße", 7), (6, "STRASSE", 8)]
    got = exact_dedup.digest_groups(spark.createDataFrame(rows, "doc_id long, text string, run int").repartition(5)).collect()
    key = lambda r: (r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept)
    assert sorted(map(key, got)) == sorted([(1, 4, 3, False), (1, 4, 3, False), (4, 4, 3, True), (0, 0, 2, True), (0, 0, 2, True), (2, 3, 2, False), (3, 3, 2, True), (5, 5, 1, True), (6, 6, 1, True)])


def test_op8_values_of_null_and_repeated_ids(spark):
    one, two = " ".join(words(71, 90)), " ".join(words(72, 90))
    rows = [(3, one, 0), (3, one, 1), (8, one + " more", 2), (9, two, 3), (None, one, 4), (10, "a b", 5), (11, "A, b!", 6), (12, None, 7), (13, "", 8)]
    got = {(r.doc_id, r.class_id, r.class_size, r.kept) for r in minhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string, band int")).collect()}
    assert got == {(3, 3, 2, True), (8, 3, 2, False), (9, 9, 1, True), (10, 10, 2, True), (11, 10, 2, False), (12, 12, 1, True), (13, 13, 1, True)}


def test_op9_values_of_null_sources_and_sizes(spark):
    rows = [(1, "a b c d", "s"), (2, None, "s"), (3, "x y", None), (None, "p q r", "t"), (4, "", "u")]
    got = {(r.doc_id, r.size, r.source_size, r.taken) for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert {(d, n, s) for d, n, s, _ in got} == {(1, 4, 4), (2, 0, 4), (3, 2, 2), (None, 3, 3), (4, 0, 0)}
    assert all(taken <= 2 * size for _, size, _, taken in got)


def test_op6_empty_table_null_and_repeated_ids(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(2, "two words"), (2, "two words"), (None, "x"), (1, None)], "doc_id long, text string")
    token_blocks.write_blocks(docs, path, str(tmp_path / "a"), segment_ids=100)
    rows = sorted(token_blocks.read_blocks(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert sum(r.n_tokens for r in rows) == rows[-1].start + rows[-1].n_tokens and len(rows) == 4
    token_blocks.write_blocks(docs.limit(0), path, str(tmp_path / "b"), segment_ids=100)
    assert token_blocks.read_blocks(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("cosine", [0.93 + 1e-9, 0.93 - 1e-9])
def test_op3_at_the_threshold(spark, cosine):
    v = [1.0] + [0.0] * 15
    w = [cosine, (1 - cosine**2) ** 0.5] + [0.0] * 14
    got = {r.vec_id: r.n_links for r in lattice_dedup.lattice_links(spark.createDataFrame([(1, v, 0), (2, w, 0)], "vec_id long, embedding array<double>, label int")).collect()}
    assert got == dict.fromkeys((1, 2), int(cosine > 0.93))


def test_op1_column_names_of_its_own_are_no_trouble(spark):
    docs = spark.createDataFrame([(k, f"the cat sat on mat {k}", "en", "x", 1) for k in range(30)], "doc_id long, text string, lang string, whole string, part int")
    model = language_id.train(docs)
    assert model.langs == ["en"] and corpus_pipeline.language_id.keep_known(docs, model).columns == docs.columns
    assert language_id.train(docs.withColumn("lang", F.lit(None).cast("string"))).langs == []


def test_op9_null_ids_equal_the_sql(spark):
    rng = np.random.default_rng(9)
    rows = [(None if k % 3 == 0 else k, " ".join(words(k, int(rng.integers(0, 30)))), f"s{k % 4}" if k % 7 else None, None, 0) for k in range(150)]
    con = duckdb.connect()
    con.register("documents", pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())])}))
    wanted = Counter((d, n, s, round(t, 6), taken) for d, n, s, t, taken in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.SQL})").fetchall())
    got = mixing.mix(spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string").repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got) == wanted
