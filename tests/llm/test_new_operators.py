"""Packing, alignment and prefix tries against brute force and their rules, on odd rows and on the tables."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import DOCS, odd_docs
from tests.oracle import connect, plain
from toolgraph.llm import alignment, cuts, packing, prefix_trie, token_blocks
from toolgraph.llm.bpe import byte_symbols

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*" \n\t\r a'sb1.,é日\x00\x01\x1c\xa0", "  ", "\n\n", " the", "<|endoftext|>", "'s", "▁"]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "  ", " \n", "a  b", "x" * 5000, "ab " * 4000]


def library(plain_special):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(BYTES)
    found.no_truncation()
    found.no_padding()
    found.encode_special_tokens = plain_special
    return found


@pytest.mark.parametrize("plain_special", [True, False])
def test_byte_level_chunks_equal_the_library(plain_special):
    texts, own = odd_texts(1500), library(plain_special)
    ids, starts = cuts.ByteLevel(BYTES, byte_symbols(), plain_special).encode(texts)
    for k, t in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == own.encode(t, add_special_tokens=False).ids, repr(t)


def test_piece_chunks_equal_the_library():
    from sentencepiece import SentencePieceProcessor

    own, texts = SentencePieceProcessor(model_file=PIECES), [t for t in odd_texts(1500) if t and "▁" not in t]
    ids, starts = cuts.Pieces(PIECES).encode([" " + t for t in texts])
    for k, t in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == own.encode(t), repr(t)


def check_packing(rows, texts, window=1024):
    own = library(False)
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault((r.doc_id, r.document), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    found = sorted((plain(d), b"".join(bytes(r.token_ids) for r in sorted(parts, key=lambda r: r.start))) for (d, _), parts in by_document.items())
    wanted = sorted((plain(d), np.array(own.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for d, t in texts)
    assert found == wanted
    for parts in by_document.values():
        parts.sort(key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *[r.length for r in parts]])[:-1].tolist()
        assert {r.doc_tokens for r in parts} == {sum(r.length for r in parts)}
        assert all(len(r.token_ids) == 4 * r.length > 0 for r in parts)
    sizes = []
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *[r.length for r in parts]])[:-1].tolist()
        sizes.append(sum(r.length for r in parts))
    assert max(sizes, default=0) <= window and all(n & (n - 1) == 0 for n in sizes)  # full, or a power of two: no padding
    assert sum(n < window for n in sizes) <= window.bit_length()


def test_packing_keeps_every_id_once_without_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check_packing(packing.pack(docs.repartition(5), BYTES).collect(), texts)
    check_packing(packing.pack(docs.repartition(7), BYTES, window=64, open_windows=3, fan_in=2).collect(), texts, 64)


def test_packing_of_odd_rows(spark):
    docs = odd_docs(spark)
    check_packing(packing.pack(docs.repartition(3), BYTES).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert packing.pack(docs.limit(0), BYTES).count() == 0
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    assert packing.pack(named, BYTES).select("doc_id").distinct().count() == named.select("doc_id").distinct().count()


def test_packing_cuts_few_documents_and_holds_few_windows():
    rng, packer, seen = random.Random(1), packing.Packer(100, 4), []
    pieces = [(k, k, 0, n, n, b"1234" * n) for k, n in enumerate(rng.randint(1, 60) for _ in range(2000))]
    for p in pieces:
        seen += packer.place(p)
        assert len(packer.held) <= 4 and all(f == 100 - sum(x[3] for x in h) > 0 for f, h in zip(packer.free, packer.held))
    assert all(sum(p[3] for p in s) == 100 for s in seen)
    seen += packer.merge_leftovers()
    assert len(packer.held) <= 1
    assert sum(len(s) for s in seen) < 1.5 * len(pieces)


def brute_alignment(texts):
    from sentencepiece import SentencePieceProcessor

    a, b = library(True), SentencePieceProcessor(model_file=PIECES)
    symbols = byte_symbols()
    spans = []
    for t in texts:
        if not t:
            spans.append(None)
            continue
        of_a = [(i, bytes(symbols[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
        of_b = []
        for i in b.encode(t):
            p = b.id_to_piece(i)
            of_b.append((i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()))
        raw = (" " + t).encode()
        spans.append((of_a, of_b) if b"".join(x for _, x in of_a) == raw == b"".join(x for _, x in of_b) else None)
    counts, links = {}, []
    for s in spans:
        own = []
        if s:
            ends_a, ends_b = (np.cumsum([len(x) for _, x in side]).tolist() for side in s)
            starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
            own = [(s[0][i][0], s[1][j][0]) for i in range(len(ends_a)) for j in range(len(ends_b)) if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]
        links.append(own)
        for p in set(own):
            counts[p] = counts.get(p, 0) + 1
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for s, own in zip(spans, links):
        if not s:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for _, x in side]).tolist() for side in s)
        shared = sorted(set(ends_a) & set(ends_b))
        groups = [(",".join(str(i) for (i, _), e in zip(s[0], ends_a) if lo < e <= hi), ",".join(str(i) for (i, _), e in zip(s[1], ends_b) if lo < e <= hi)) for lo, hi in zip([0, *shared[:-1]], shared)]
        out.append((len(s[0]), len(s[1]), len(groups), len(own), sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), ";".join(f"{x}|{y}" for x, y in groups)))
    return out


@pytest.mark.parametrize("block_bytes, broadcast", [(500, 0), (1 << 20, 1 << 20)])
def test_alignment_equals_brute_force(spark, sf_dir, block_bytes, broadcast, monkeypatch):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", broadcast)
    texts = [t[:3000] for t in odd_texts(120)] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 900").collect()][:60] + [None, None]
    docs = spark.createDataFrame([(k if k % 50 else None, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, pairs string").repartition(3)
    found = sorted(tuple(r)[1:] for r in alignment.align(docs, BYTES, PIECES, block_bytes).collect())
    assert found == sorted(brute_alignment(texts))


def test_alignment_of_an_empty_table_and_the_query(spark, sf_dir):
    docs = spark.createDataFrame([], DOCS)
    assert alignment.align(docs, BYTES, PIECES).count() == 0
    rows = alignment.op12_alignment(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(len(r.groups_sha256) == 64 * (r.n_a > 0) and r.n_links == r.n_a + r.n_b - r.n_groups for r in rows)


def brute_trie(turns):
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(rows)] for c, rows in own.items()}
    built = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + rows[h:]
    nodes = {}
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            nodes.setdefault(tuple(rows[:d]), []).append(c)
    out = []
    words = lambda t: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w])
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * words(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(path))))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_equals_brute_force(spark):
    rng = random.Random(1)
    turns = []
    for c in [*rng.sample(range(-45, 130), 60), None]:
        for t in range(rng.randint(1, 7)):
            row = (c, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["hello there", "a", "", None, "b c d"]))
            turns += [row] * rng.choice([1, 1, 2])
    turns += [(7, t, "user", f"long {t % 3}") for t in range(300)] + [(8, t, "user", f"long {t % 3}") for t in range(200)]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, slice string")
    wanted = sorted(map(plain, brute_trie(turns)))
    for parts, fan_in, bits in ((1, 64, 16), (5, 2, 2)):
        found = prefix_trie.prefix_trie(df.repartition(parts), fan_in, bits).select(*COLUMNS).collect()
        assert sorted(plain(tuple(r)) for r in found) == wanted


def test_trie_splits_a_long_conversation_over_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHAIN_BLOCK", 7)
    turns = [(40, t, "user", f"t{t}") for t in range(400)] + [(41, t, "user", f"t{t}") for t in range(390)] + [(60, 0, "user", "t0")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        assert prefix_trie.numbered(prefix_trie.turn_digests(df)).filter("conv_id = 40").select("part").distinct().count() > 1
        found = prefix_trie.prefix_trie(df).select(*COLUMNS).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(plain(tuple(r)) for r in found) == sorted(map(plain, brute_trie(turns)))


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_crc_in_sql():
    for s in ("0", "7", "123456789", "-40"):
        assert connect("/root/testdata/sf0.001").execute("SELECT " + prefix_trie.CRC32_SQL.format(s="s") + f" FROM (SELECT '{s}' AS s)").fetchone()[0] == zlib.crc32(s.encode())


def test_op6_library_gets_chunks_without_words_between(monkeypatch):
    encoder = token_blocks.LibraryEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["The cat, ¤ | sat.. ... on a|b don't!? ß. Ünï? éx; ́ 日本語。 x1, 2. É.", "", None, "the CAT. cat! ,cat \x1c a\x1db", "†.§, 😀! 😀😀, ~", "İx, Σ."]
    plain = [encoder.ask([t])[0].tobytes() if t else b"" for t in texts]
    asked, ask = [], encoder.ask
    monkeypatch.setattr(encoder, "ask", lambda given: asked.append(list(given)) or ask(given))
    assert encoder.encode(texts).to_pylist() == plain
    assert encoder.encode(texts[::-1]).to_pylist() == plain[::-1]  # now remembered
    assert all(len(given) == 1 for given in asked)  # no chunk had to be asked for alone
    words = [w for given in asked for w in given[0].split(" ") if w]
    assert words.count("¤") == words.count("|") == 1 and "¬" not in words  # those of the texts only
    assert not any(c.isspace() for a in encoder.added for c in a)
