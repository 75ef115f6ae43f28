"""Alignment of two tokenizers over one text, byte by byte.

Documents are handled in blocks of a task's input. A text is cut into chunks
that both tokenizers encode on their own (see :mod:`cuts`), and a block aligns
each distinct chunk once, in DuckDB: the tokens of either side are intervals on
one axis of bytes; ASOF joins pair each token with the token of the other side
that covers its start, and a range condition keeps the overlaps, without a
quadratic join; window sums over shared starts number the groups. The block then counts, for each pair of
ids, in how many of its documents the pair is linked. Spark merges these partial
counts and finds each A id's highest. At most ``BROADCAST_PAIRS`` pairs go to all
tasks; if there are more, every block gets the counts of its own pairs by a join,
in which no pair, however common, is more than one row a block.

Between the two steps a block is kept as compressed arrays: which chunk stands
where, and the chunks' ids, groups and links.

Defined results: a text that is null, empty or not spelt by its tokens (for
example one with U+2581, which the pieces use for the space) has no tokens: all
counts are 0 and ``groups`` is empty. Rows of null or repeated doc_ids are
documents of their own. Other columns are ignored. An empty table gives an empty
result. The memory of a task is bounded by a block, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.bpe import byte_symbols
from toolgraph.llm.cuts import ByteLevel, Library, Pieces, blocks as text_blocks, buffers, cut, gathered
from toolgraph.scratch import materialize, new_path

#: bytes of text in a block
BLOCK_BYTES = 3 << 21
#: pairs whose counts are broadcast, at most (17 bytes each); more are joined to the blocks that hold them
BROADCAST_PAIRS = 1 << 20
#: bytes of a row group of blocks: a task holds one while it writes and one while it reads
ROW_GROUP = 1 << 23
#: a pair of ids as one number
SIDE_BITS = 20
#: what stands behind an id: between ids of a side, sides, groups, and at a chunk's end
SIGNS = [",", "|", ";", ""]
#: documents whose groups are written out at once
TEXTS_AT_ONCE = 256

COVER_SQL = """
CREATE TEMP TABLE cover AS
SELECT b.k AS bk, a.k AS ak, a.chunk, (a.id::BIGINT << 20) + b.id AS pair, a.s = b.s AS opens FROM b ASOF JOIN a ON b.s >= a.s
"""
LINKS_SQL = """
CREATE TEMP TABLE link AS
SELECT chunk, pair, count(*)::INT AS n FROM (
  SELECT chunk, pair FROM cover
  UNION ALL
  SELECT a.chunk, (a.id::BIGINT << 20) + b.id FROM a ASOF JOIN b ON a.s > b.s WHERE a.s < b.e)
GROUP BY chunk, pair
"""
A_GROUPS_SQL = "SELECT sum((o.ak IS NOT NULL)::INT) OVER (ORDER BY a.k)::BIGINT AS grp FROM a LEFT JOIN (SELECT ak FROM cover WHERE opens) o ON o.ak = a.k ORDER BY a.k"
B_GROUPS_SQL = "SELECT sum(opens::INT) OVER (ORDER BY bk)::BIGINT AS grp FROM cover ORDER BY bk"
PAIRS_SQL = "SELECT pair, count(*)::INT AS n FROM (SELECT DISTINCT doc, pair FROM occurrence JOIN link USING (chunk)) GROUP BY pair ORDER BY pair"


class Block(NamedTuple):
    """Documents as chunks, and the alignment of each chunk."""

    #: places before each document (one more entry), and the chunk at each place
    starts: np.ndarray
    codes: np.ndarray
    #: each chunk's ids, and the group that each id belongs to
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_groups: np.ndarray
    b_groups: np.ndarray
    #: links: their chunk, their pair's place among the block's pairs, how many there are
    link_chunk: np.ndarray
    link_pair: np.ndarray
    link_n: np.ndarray

    def packed(self) -> bytes:
        """Compressed; ascending numbers as differences."""
        arrays = [np.diff(x, prepend=0) if name in ASCENDING else x for name, x in zip(self._fields, self, strict=True)]
        raw = np.concatenate([np.array([len(x) for x in self]), *arrays]).astype("<u4").tobytes()
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


ASCENDING = {"starts", "a_groups", "b_groups", "link_chunk"}


def unpacked(data: bytes) -> Block:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd")
    flat = np.frombuffer(raw, "<u4").astype(np.int64)
    fields = len(Block._fields)
    arrays = np.split(flat[fields:], np.cumsum(flat[:fields])[:-1])
    return Block(*[np.cumsum(x) if name in ASCENDING else x for name, x in zip(Block._fields, arrays, strict=True)])


@lru_cache(maxsize=1)
def libraries(a_path: str, b_path: str) -> tuple[Library, Library]:
    return ByteLevel(a_path, byte_symbols(), plain_special=True), Pieces(b_path)


def spelt(library: Library, chunks: pa.LargeStringArray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each chunk's bytes are what its tokens' bytes join to."""
    data, starts = buffers(chunks)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    widths = np.diff(np.concatenate([[0], np.cumsum(library.width_of[ids])])[ends])
    if (widths == np.diff(starts)).all() and library.bytes_of(ids) == data.tobytes():
        return np.ones(len(chunks), dtype=bool)
    each = zip(starts[:-1].tolist(), starts[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)
    return np.array([library.bytes_of(ids[c:d]) == data[a:b].tobytes() for a, b, c, d in each], dtype=bool)


def aligned_block(texts: list[str | None], a: Library, b: Library) -> tuple[Block, np.ndarray, np.ndarray]:
    """Some documents (a space before each text), their pairs, and in how many of the documents each pair is linked."""
    distinct, codes, starts = cut([" " + t if t else "" for t in texts])
    (a_ids, a_sizes), (b_ids, b_sizes) = a.encode_chunks(distinct), b.encode_chunks(distinct)
    good = spelt(a, distinct, a_ids, a_sizes) & spelt(b, distinct, b_ids, b_sizes)
    if not good.all():
        document = np.repeat(np.arange(len(texts)), np.diff(starts))
        lost = np.zeros(len(texts), dtype=bool)
        lost[document[~good[codes]]] = True
        keep = ~lost[document]
        starts = np.concatenate([[0], np.cumsum(keep)])[starts]
        used, codes = np.unique(codes[keep], return_inverse=True)
        a_ids, b_ids = gathered(a_ids, a_sizes, used)[0], gathered(b_ids, b_sizes, used)[0]
        a_sizes, b_sizes = a_sizes[used], b_sizes[used]

    del distinct, good
    pa.default_memory_pool().release_unused()
    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
    for name, sizes, ids, width in (("a", a_sizes, a_ids, a.width_of), ("b", b_sizes, b_ids, b.width_of)):
        own = width[ids]
        ends = np.cumsum(own)
        chunk = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        con.register(name, pa.table({"k": np.arange(len(ids), dtype=np.int32), "chunk": chunk, "id": ids.astype(np.int32), "s": ends - own, "e": ends}))
    document = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(starts))
    both = np.sort((document << 32) + codes)
    both = both[np.diff(both, prepend=-1) > 0]
    con.register("occurrence", pa.table({"doc": (both >> 32).astype(np.int32), "chunk": (both & 0xFFFFFFFF).astype(np.int32)}))
    con.execute(COVER_SQL)
    a_groups, b_groups = (con.execute(q).fetchnumpy()["grp"] for q in (A_GROUPS_SQL, B_GROUPS_SQL))
    con.execute("SET preserve_insertion_order = false")
    con.execute(LINKS_SQL)
    counted = con.execute(PAIRS_SQL).fetchnumpy()
    links = con.execute("SELECT chunk, pair, n FROM link ORDER BY chunk").fetchnumpy()
    con.close()
    link_pair = np.searchsorted(counted["pair"], links["pair"])
    block = Block(starts, codes, a_sizes, b_sizes, a_ids, b_ids, a_groups, b_groups, links["chunk"], link_pair, links["n"])
    return block, counted["pair"], counted["n"]


@lru_cache(maxsize=1)
def written_ids(ids: int) -> pa.Array:
    """Each id's digits, followed by each of the signs."""
    return pa.array([f"{i}{sign}" for i in range(ids) for sign in SIGNS], pa.large_string())


def chunk_groups(block: Block, ids: int) -> pa.Array:
    """Each chunk's groups written out."""
    if not len(block.a_ids):
        return pa.array([""] * len(block.a_sizes), pa.large_string())
    a_group, b_group = block.a_groups - 1, block.b_groups - 1
    groups = int(a_group[-1]) + 1
    of_a, of_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_before, b_before = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
    a_last, b_last = np.append(a_group[1:] != a_group[:-1], True), np.append(b_group[1:] != b_group[:-1], True)
    chunk_end = np.zeros(len(block.b_ids), dtype=bool)
    chunk_end[np.cumsum(block.b_sizes) - 1] = True
    which = np.empty(len(block.a_ids) + len(block.b_ids), np.int64)
    which[np.arange(len(block.a_ids)) + b_before[a_group]] = block.a_ids * len(SIGNS) + a_last
    which[np.arange(len(block.b_ids)) + (a_before + of_a)[b_group]] = block.b_ids * len(SIGNS) + np.where(chunk_end, 3, 2 * b_last)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(block.a_sizes + block.b_sizes)])), written_ids(ids).take(pa.array(which)))
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def block_schema(doc_id: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(doc_id)),
        T.StructField("payload", T.BinaryType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("docs", T.ArrayType(T.IntegerType())),
    ])


def encoded_blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int) -> DataFrame:
    """One row a block of documents: their ids, the packed block, and its pairs' document counts."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    schema = block_schema(rows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = libraries(a_path, b_path)
        for k, table in enumerate(text_blocks(batches, block_bytes)):
            block, pairs, docs_of = aligned_block(table.column(1).to_pylist(), a, b)
            ids = table.column(0).combine_chunks()
            columns = [
                pa.array([(TaskContext.get().partitionId() << 32) + k], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([block.packed()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs, pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(docs_of, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def corpus_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents each pair is linked, and whether no pair of the same A id is linked in more."""
    partial = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = partial.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.docs").cast("long")).alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", SIDE_BITS))  # at most as many rows as B has ids
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def aligned_documents(block: Block, doc_ids: pa.Array, count: np.ndarray, best: np.ndarray, ids: int) -> Iterator[list[pa.Array]]:
    """Columns of some of a block's documents at a time. ``count`` and ``best``: of the block's pairs, in their order."""
    chunks, n = len(block.a_sizes), block.link_n
    of_chunk = lambda weight: np.diff(np.concatenate([[0], np.cumsum(weight)])[np.searchsorted(block.link_chunk, np.arange(chunks + 1))])
    group_of_chunk = np.append(block.a_groups, 0)[np.cumsum(block.a_sizes) - 1]  # the last group so far
    sums = [block.a_sizes, block.b_sizes, np.diff(group_of_chunk, prepend=0), of_chunk(n), of_chunk(n * best[block.link_pair]), of_chunk(n * count[block.link_pair])]
    running = [np.concatenate([[0], np.cumsum(s[block.codes])]) for s in sums]
    texts = chunk_groups(block, ids)
    for first in range(0, len(doc_ids), TEXTS_AT_ONCE):
        bounds = block.starts[first : first + TEXTS_AT_ONCE + 1]
        lists = pa.LargeListArray.from_arrays(pa.array(bounds - bounds[0]), texts.take(pa.array(block.codes[bounds[0] : bounds[-1]])))
        groups = pc.binary_join(lists, pa.scalar(";", pa.large_string()))
        yield [doc_ids.slice(first, TEXTS_AT_ONCE), *[pa.array(np.diff(r[bounds])) for r in running], groups.cast(pa.string())]


def align(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (text)."""
    spark = docs.sparkSession
    path = new_path(spark, "token-blocks")
    rows = encoded_blocks(docs, a_path, b_path, block_bytes)
    rows.write.option("parquet.block.size", ROW_GROUP).option("compression", "uncompressed").parquet(path)  # payloads are compressed
    blocks = spark.read.schema(rows.schema).parquet(path)
    counts = materialize(corpus_counts(blocks), "pair-counts")
    longs = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_ids"].dataType.elementType), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("groups", T.StringType())])
    ids = max(len(x.width_of) for x in libraries(a_path, b_path))

    def documents(doc_ids: pa.Array, payload: bytes, count: np.ndarray, best: np.ndarray) -> list[pa.RecordBatch]:
        kinds = [doc_ids.type, *[pa.int64()] * len(longs), pa.string()]
        out = pa.schema(list(zip(schema.names, kinds, strict=True)))
        return [pa.RecordBatch.from_arrays(p, schema=out) for p in aligned_documents(unpacked(payload), doc_ids, count, best, ids)]

    if counts.count() <= BROADCAST_PAIRS:
        few = counts.orderBy("pair").toPandas()
        shared = spark.sparkContext.broadcast((few["pair"].to_numpy(np.int64), few["count"].to_numpy(np.int64), few["best"].to_numpy(bool)))

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, count, best = shared.value
            for batch in batches:
                for k in range(batch.num_rows):
                    at = np.searchsorted(pair, batch.column(2)[k].values.to_numpy())
                    yield from documents(batch.column(0)[k].values, batch.column(1)[k].as_py(), count[at], best[at])

        return blocks.select("doc_ids", "payload", "pairs").mapInArrow(alone, schema)

    def joined(own: pa.Table, counts: pa.Table) -> pa.Table:
        counts = counts.sort_by("pair")
        parts = documents(own.column("doc_ids")[0].values, own.column("payload")[0].as_py(), counts.column("count").to_numpy(), counts.column("best").to_numpy())
        return pa.Table.from_batches(parts)

    own = blocks.select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair")).join(counts, "pair")
    return blocks.select("block", "doc_ids", "payload").groupBy("block").cogroup(own.groupBy("of_block")).applyInArrow(joined, schema)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    aligned = align(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return aligned.select(*aligned.columns[:-1], F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))
