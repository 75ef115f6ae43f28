"""Document frequencies are those of shingles themselves, however many there are."""

from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.test_operators import words
from toolgraph.llm import frequencies, minhash


def test_op8_frequencies_are_exact_beyond_any_fixed_table(spark):
    """700,000 distinct shingles, more than twice the 2**18 counters there once were; a common passage keeps its weight."""
    rng = np.random.default_rng(6)
    passage = words(61, 60)
    rows = [(k, " ".join([*(passage if k < 20 else []), *(f"u{v}" for v in rng.integers(0, 10**12, 3500))])) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    n, counts = minhash.document_frequencies(df)
    idf = minhash.inverse_frequencies(n, counts)
    exact = Counter()
    sets = [s for s, _ in minhash.document_shingles(pa.array([t for _, t in rows], pa.string()), 5)]
    for s in sets:
        exact.update(s.tolist())
    for s in (sets[0], sets[19], sets[100]):
        assert np.allclose(idf.idf(s), np.log1p(200 / np.array([exact[v] for v in s.tolist()])))
    for r in minhash.with_frequencies(df, n, counts).filter("doc_id IN (0, 100)").collect():
        own = minhash.Frequencies.unpacked(n, bytes(r.frequencies))
        assert np.array_equal(own.idf(sets[r.doc_id]), idf.idf(sets[r.doc_id]))


def test_op8_frequencies_by_way_of_groups_are_the_direct_ones(spark, monkeypatch):
    """More blocks than go straight to buckets, and than there are tasks; each block's answers are those of a plain count."""
    shared = words(62, 40)
    rows = [(k, " ".join([*shared[k % 7 : k % 7 + 30], *words(k, 40), *(f"u{k}x{v}" for v in range(100))])) for k in range(300)] + [(1000, None), (1001, ""), (1002, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    blocks = 50
    exact, per_block = Counter(), {}
    of = {r.doc_id: r.block for r in df.select("doc_id", frequencies.block_of(blocks)).collect()}
    for (doc, _), (s, _) in zip(rows, minhash.document_shingles(pa.array([t for _, t in rows], pa.string()), 5), strict=True):
        exact.update(s.tolist())
        per_block.setdefault(of[doc], set()).update(s.tolist())
    want = {b: {s: exact[s] for s in own if exact[s] > 1} for b, own in per_block.items()}

    def found():
        got = {}
        for r in frequencies.shared_shingles(df, 5, blocks).collect():
            held = frequencies.from_planes(bytes(r.held), np.uint32).tolist()
            got.setdefault(r.block, {}).update(zip(frequencies.unpacked(bytes(r.shingles)).tolist(), held, strict=True))
        return got

    want = {b: own for b, own in want.items() if own}
    assert found() == want
    monkeypatch.setattr(frequencies, "TASKS", 6)
    assert found() == want
    monkeypatch.setattr(frequencies, "DIRECT_BLOCKS", 9)
    assert found() == want
    df.unpersist()


def test_op8_frequencies_of_no_documents(spark, monkeypatch):
    monkeypatch.setattr(frequencies, "DIRECT_BLOCKS", 1)
    assert frequencies.shared_shingles(spark.createDataFrame([], "doc_id long, text string"), 5, 4).count() == 0


def test_op8_runs_grow_with_text_times_its_root(spark):
    """Runs sent by way of groups: 16 times the blocks of equal size make 64 times the runs, not 256 times, and their length shrinks by 4."""

    def runs(blocks):
        docs = spark.range(2 * blocks).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 200), k -> concat('w', id, 'x', k)), ' ') AS text").cache()
        width = round(blocks**0.5)
        sent = frequencies.sorted_runs(docs, 5, blocks, width)
        merged = frequencies.group_runs(sent, width, width * width)
        counts = sent.count(), merged.count()
        docs.unpersist()
        return counts

    small, large = runs(16), runs(256)
    assert large[0] <= 64 * small[0] * 1.5 and large[1] <= 64 * small[1] * 1.5


def test_shared_shingles_are_looked_up_in_ranges():
    rng = np.random.default_rng(11)
    for n in (0, 1, 2, 1000):
        found = np.unique(np.append(rng.integers(0, 2**64, n, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)[: n // 2]))
        held = np.arange(2, 2 + len(found), dtype=np.uint32)
        known = frequencies.Shared([frequencies.packed(found)], [frequencies.by_planes(held)])
        asked = np.concatenate([found, found + np.uint64(1), rng.integers(0, 2**64, 500, dtype=np.uint64)])
        of = dict(zip(found.tolist(), held.tolist(), strict=True))
        assert known.of(asked).tolist() == [of.get(s, 1) for s in asked.tolist()]
