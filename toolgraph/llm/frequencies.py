"""Exact document frequencies of word shingles, without a shuffled row a shingle.

1. Documents are dealt into *blocks* by a hash of doc_id, as many as there are
   shuffle partitions, more if a block would pass ``BLOCK_BYTES`` of text. A
   task works through several blocks where there are more than ``TASKS``.
2. Each block sends its distinct shingles, with how many of its documents hold
   them, as one sorted run a *bucket* (a range of hash values). Runs are
   differences of sorted hashes by byte planes, which compress to five or six
   bytes a shingle. A shingle stands once in a block's run, however many
   documents hold it, so no bucket is hot.
3. A bucket adds up the counts of its runs and returns to each block those of
   its shingles that more than one document holds. All others have frequency 1.
4. With more than ``DIRECT_BLOCKS`` blocks a run between each block and each
   bucket would be a few shingles long, and their number the square of the
   text. So runs go by way of groups: about sqrt(n) of the n blocks form a group
   and as many buckets a *span*. A block sends a run a span; a group's runs of
   one span are merged, with the block of each entry beside it, and cut into one
   run a bucket; answers return the same way. That makes n * sqrt(n) runs.

Every count is over all documents; nothing is broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from toolgraph.llm.shingles import shingle_hashes, word_hashes
from toolgraph.llm.wordsplit import slices

#: bytes of text that a block holds on average, at most
BLOCK_BYTES = 1 << 24
#: shingles that a task gathers before it sends a run
RUN_ENTRIES = 1 << 22
#: blocks up to which each sends its runs straight to the buckets
DIRECT_BLOCKS = 2048
#: tasks of a stage, at most
TASKS = 8192
ROWS_AT_ONCE = 128
SIDE = "block int, shingles binary, held binary"


def by_planes(values: np.ndarray) -> bytes:
    """First bytes of all integers, then second bytes and so on: small integers leave planes of zeros, which compress to nothing."""
    values = np.ascontiguousarray(values)
    values = values.view(f"u{values.itemsize}")
    return b"".join((values >> values.dtype.type(8 * k)).astype(np.uint8).tobytes() for k in range(values.itemsize))


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(kind).reshape(-1)


def packed(shingles: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as differences by byte planes."""
    return by_planes(np.diff(shingles, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def document_shingles(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingles of each text, and their counts."""
    words, starts = word_hashes(texts)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        yield np.unique(shingle_hashes(words[a:b], size), return_counts=True)


def distinct_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text that has any."""
    words, starts = word_hashes(texts)
    every = shingle_hashes(words, size)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        own = np.sort(every[a : b - size + 1] if b - a >= size else shingle_hashes(words[a:b], size))
        if len(own):
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Number of documents, and number of blocks to deal them into."""
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()
    return n, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))


def block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block")


def tasks_of(blocks: int) -> int:
    return min(blocks, TASKS)


def by_block(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut where the number in ``column`` changes, with that number."""
    for batch in batches:
        numbers = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end > begin:
                yield int(numbers[begin]), batch.slice(begin, end - begin)


def range_edges(buckets: int) -> np.ndarray:
    """Where the second and all further of so many equal ranges of hash values begin."""
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def cut_at(found: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of each range's part of the sorted ``found``, and the ranges that have one."""
    cuts = np.concatenate([[0], np.searchsorted(found, edges), [len(found)]])
    return cuts, np.flatnonzero(cuts[1:] > cuts[:-1])


def sorted_runs(docs: DataFrame, size: int, blocks: int, buckets: int) -> DataFrame:
    """(bucket, block, shingles, held): each block's distinct shingles by range of hash values, and how many of its documents hold them."""
    edges = range_edges(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []
        entries, last = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            if not entries:
                return
            found, held = np.unique(np.concatenate(gathered), return_counts=True)
            cuts, some = cut_at(found, edges)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int32()),
                    pa.array(np.full(len(some), last), pa.int32()),
                    pa.array([packed(found[cuts[k] : cuts[k + 1]]) for k in some], pa.binary()),
                    pa.array([by_planes(held[cuts[k] : cuts[k + 1]].astype(np.uint32)) for k in some], pa.binary()),
                ],
                ["bucket", "block", "shingles", "held"],
            )

        for block, batch in by_block(slices(batches, ROWS_AT_ONCE), 1):
            if block != last or entries > RUN_ENTRIES:
                yield from flush()
                gathered, entries, last = [], 0, block
            for own in distinct_shingles(batch.column(0), size):
                gathered.append(own)
                entries += len(own)
        yield from flush()

    dealt = docs.select("text", block_of(blocks)).repartitionById(tasks_of(blocks), F.col("block") % tasks_of(blocks))
    if blocks > TASKS:
        dealt = dealt.sortWithinPartitions("block")
    return dealt.mapInArrow(run, "bucket int, block int, shingles binary, held binary")


def bucket_totals(runs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, shingles, held, owner) of runs (bucket, block, shingles, held, owner): only the entries that more than one of all documents holds, and how many do."""

    def totals(of: list[tuple[int, int]], runs: list[np.ndarray], counts: list[np.ndarray], owners: list[np.ndarray | None]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate(runs)
        order = np.argsort(every, kind="stable")
        placed = every[order]
        begin = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]]))
        total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), begin)
        held = np.empty(len(every), np.int64)
        held[order] = np.repeat(total, np.diff(np.concatenate([begin, [len(every)]])))
        at = 0
        for (bucket, block), own, owner in zip(of, runs, owners, strict=True):
            here = held[at : at + len(own)]
            at += len(own)
            if (here > 1).any():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket], pa.int32()),
                        pa.array([block], pa.int32()),
                        pa.array([packed(own[here > 1])], pa.binary()),
                        pa.array([by_planes(here[here > 1].astype(np.uint32))], pa.binary()),
                        pa.array([None if owner is None else by_planes(owner[here > 1])], pa.binary()),
                    ],
                    ["bucket", "block", "shingles", "held", "owner"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, runs, counts, owners = [], [], [], []
        for bucket, batch in by_block(batches, 0):
            if of and of[-1][0] != bucket:
                yield from totals(of, runs, counts, owners)
                of, runs, counts, owners = [], [], [], []
            of += [(bucket, block) for block in batch.column(1).to_pylist()]
            runs += [unpacked(x.as_py()) for x in batch.column(2)]
            counts += [from_planes(x.as_py(), np.uint32) for x in batch.column(3)]
            owners += [from_planes(x.as_py(), np.uint16) if x.is_valid else None for x in batch.column(4)]
        if of:
            yield from totals(of, runs, counts, owners)

    dealt = runs.repartitionById(tasks_of(buckets), F.col("bucket") % tasks_of(buckets))
    if buckets > TASKS:
        dealt = dealt.sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket int, block int, shingles binary, held binary, owner binary")


def group_runs(runs: DataFrame, width: int, buckets: int) -> DataFrame:
    """(bucket, block, shingles, held, owner): runs (bucket: a span, block) of ``width`` blocks merged into one a bucket. ``block`` is the group, ``owner`` the place in it of each entry's block."""
    edges = range_edges(buckets)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        group = key[1].as_py()
        every = [unpacked(x.as_py()) for x in table["shingles"]]
        owners = np.repeat([b - group * width for b in table["block"].to_pylist()], [len(e) for e in every]).astype(np.uint16)
        held = np.concatenate([from_planes(x.as_py(), np.uint32) for x in table["held"]])
        found = np.concatenate(every)
        order = np.lexsort((owners, found))
        found, owners, held = found[order], owners[order], held[order]
        cuts, some = cut_at(found, edges)
        return pa.table(
            [
                pa.array(some, pa.int32()),
                pa.array(np.full(len(some), group), pa.int32()),
                pa.array([packed(found[cuts[k] : cuts[k + 1]]) for k in some], pa.binary()),
                pa.array([by_planes(held[cuts[k] : cuts[k + 1]]) for k in some], pa.binary()),
                pa.array([by_planes(owners[cuts[k] : cuts[k + 1]]) for k in some], pa.binary()),
            ],
            ["bucket", "block", "shingles", "held", "owner"],
        )

    grouped = runs.withColumn("group", F.floor(F.col("block") / width).cast("int")).groupBy("bucket", "group")
    return grouped.applyInArrow(merge, "bucket int, block int, shingles binary, held binary, owner binary")


def ungrouped(answers: DataFrame, width: int) -> DataFrame:
    """(block, shingles, held): answers (bucket, block: a group, shingles, held, owner) of ``width`` buckets dealt out to the group's blocks."""

    def deal(key: tuple, table: pa.Table) -> pa.Table:
        group = key[1].as_py()
        found = np.concatenate([unpacked(x.as_py()) for x in table["shingles"]])
        held = np.concatenate([from_planes(x.as_py(), np.uint32) for x in table["held"]])
        owners = np.concatenate([from_planes(x.as_py(), np.uint16) for x in table["owner"]])
        order = np.lexsort((found, owners))
        found, owners, held = found[order], owners[order], held[order]
        begin = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]])).tolist()
        parts = list(zip(begin, [*begin[1:], len(owners)], strict=True))
        return pa.table(
            [
                pa.array([group * width + int(owners[a]) for a, _ in parts], pa.int32()),
                pa.array([packed(found[a:b]) for a, b in parts], pa.binary()),
                pa.array([by_planes(held[a:b]) for a, b in parts], pa.binary()),
            ],
            ["block", "shingles", "held"],
        )

    spans = answers.withColumn("span", F.floor(F.col("bucket") / width).cast("int")).groupBy("span", "block")
    return spans.applyInArrow(deal, SIDE)


def shared_shingles(docs: DataFrame, size: int, blocks: int) -> DataFrame:
    """(block, shingles, held): of each block the shingles that more than one of all documents holds, and how many do; a block has several rows."""
    if blocks <= DIRECT_BLOCKS:
        runs = sorted_runs(docs, size, blocks, blocks).withColumn("owner", F.lit(None).cast("binary"))
        return bucket_totals(runs, blocks).select("block", "shingles", "held")
    width = math.isqrt(blocks - 1) + 1  # at most 2**16 up to 2**32 blocks
    buckets = width * width
    return ungrouped(bucket_totals(group_runs(sorted_runs(docs, size, blocks, width), width, buckets), buckets), width)


class Shared:
    """The shingles of a block that several documents hold, and how many do; all others are held by one."""

    def __init__(self, shingles: list[bytes], held: list[bytes]):
        found = np.concatenate([np.zeros(0, np.uint64), *map(unpacked, shingles)])
        counts = np.concatenate([np.zeros(0, np.uint32), *(from_planes(h, np.uint32) for h in held)])
        self.shingles, first = np.unique(found, return_index=True)  # two runs of a block may hold the same
        self.held = counts[first].astype(np.int64)
        # where the shingles of each of so many equal ranges begin: one or two a range, since they are hashes
        bits = max(1, len(self.shingles).bit_length())
        self.shift = np.uint64(64 - bits)
        self.begin = np.append(np.searchsorted(self.shingles, np.arange(1 << bits, dtype=np.uint64) << self.shift), len(self.shingles)).astype(np.int32)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        out = np.ones(len(shingles), np.int64)
        ranges = (shingles >> self.shift).view(np.int64)
        at, end = self.begin[ranges], self.begin[ranges + 1]
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            there = self.shingles[at]
            same = there == shingles[left]
            out[left[same]] = self.held[at[same]]
            at += 1
            on = (there < shingles[left]) & (at < end)
            left, at, end = left[on], at[on], end[on]
        return out


def with_shared(docs: DataFrame, shared: DataFrame, blocks: int, work: Callable[[pa.Table, Shared], Iterator[pa.RecordBatch]], schema: T.StructType, only: DataFrame | None = None) -> DataFrame:
    """``work`` on slices (doc_id, text) of each block together with its shared shingles. ``only``: a table of the doc_ids that are wanted."""
    side, chosen = shared, only is not None
    if chosen:
        side = shared.withColumn("wanted", F.lit(None).cast(docs.schema["doc_id"].dataType)).unionByName(only.select(block_of(blocks), F.col("doc_id").alias("wanted")), allowMissingColumns=True)

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])  # nullable, as Arrow's arrays are
    kinds = to_arrow_schema(schema)

    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        rows = known.filter(pc.is_valid(known["shingles"]))
        frequencies = Shared([x.as_py() for x in rows["shingles"]], [x.as_py() for x in rows["held"]])
        own = own.select(["doc_id", "text"])
        if chosen:
            own = own.filter(pc.is_in(own["doc_id"], value_set=known["wanted"].combine_chunks().drop_null()))
        return pa.Table.from_batches([out for batch in slices(own.to_batches(), ROWS_AT_ONCE) if batch.num_rows for out in work(batch, frequencies)], kinds)

    return docs.select("doc_id", "text", block_of(blocks)).groupBy("block").cogroup(side.groupBy("block")).applyInArrow(run, schema)
