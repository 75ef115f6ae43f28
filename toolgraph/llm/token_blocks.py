"""Token-id files of patched frame-of-reference blocks.

Documents are range-partitioned and sorted by doc_id; each task encodes its
texts with the tokenizers library, appends the end id and cuts its documents
into segments of about ``SEGMENT_IDS`` ids (whole documents). A segment is one
self-contained byte string: ids in blocks of 256, each block stored as its
minimum, the differences packed at the width that a percentile of them needs,
and an exception list (positions and high bits) for those that need more; an
index holds where each block starts, so any block can be read alone. Segments
are rows of a Parquet table next to their documents' ids and lengths, so
Spark's commit protocol covers lost executors and any file system works.

Layout of a segment (little-endian): magic ``PFR1``, u32 number of ids, u32
number of blocks, (blocks + 1) u64 block starts, then the blocks. A block: u32
minimum, u8 width, u16 number of exceptions, the packed differences (width bits
each, block-size of them, lowest bit first), u8 position and u32 high bits of
each exception. The last block is filled up with its own minimum.

Defined results: null text counts as empty, so a document has at least the end
id. Ties of a repeated doc_id keep the order of (doc_id, text). Null doc_ids
come first. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.bpe import END_OF_WORD
from toolgraph.scratch import new_path
from toolgraph.llm.wordsplit import ENCODED_BYTES, ChunkCache, slices

BLOCK = 256
SEGMENT_IDS = 1 << 18
PERCENTILE = 95
END_ID = 1
MAGIC = b"PFR1"
HEAD = struct.Struct("<IBH")
#: chunks in one text for the library
AT_ONCE = 2048
#: rows that are encoded at once, if they have no more than ENCODED_BYTES
ROWS_AT_ONCE = 8192
SEGMENTS = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("first_id", T.LongType()),
    T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("n_tokens", T.ArrayType(T.LongType())),
    T.StructField("payload", T.BinaryType()),
])


def pack_bits(values: np.ndarray, w: int) -> np.ndarray:
    """(rows, BLOCK) integers below 2**w to (rows, BLOCK * w / 8) bytes. Eight values fill w bytes; all groups go at once."""
    groups = np.zeros((len(values), BLOCK // 8, w), np.uint8)
    for lane in range(8):
        own, at, shift = values[:, lane::8].astype(np.uint64), lane * w // 8, lane * w % 8
        own <<= np.uint64(shift)
        for k in range(-(-(shift + w) // 8)):
            groups[:, :, at + k] |= (own >> np.uint64(8 * k)).astype(np.uint8)
    return groups.reshape(len(values), -1)


def unpack_bits(packed: np.ndarray, w: int) -> np.ndarray:
    groups = packed.reshape(len(packed), BLOCK // 8, w)
    out = np.zeros((len(packed), BLOCK), np.uint64)
    mask = np.uint64((1 << w) - 1)
    for lane in range(8):
        at, shift = lane * w // 8, lane * w % 8
        own = np.zeros((len(packed), BLOCK // 8), np.uint64)
        for k in range(-(-(shift + w) // 8)):
            own |= groups[:, :, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane::8] = (own >> np.uint64(shift)) & mask
    return out


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One segment. Blocks of one width are packed together."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    full = np.empty(blocks * BLOCK, dtype=np.uint32)
    full[:n] = ids
    if n < len(full):
        full[n:] = full[(blocks - 1) * BLOCK : n].min()
    rows = full.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    off = rows - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    at_percentile = np.partition(off, rank, axis=1)[:, rank] if blocks else low
    width = np.frexp(at_percentile.astype(np.float64))[1]  # bits that the value needs
    parts: list[bytes] = [b""] * blocks
    for w in map(int, np.unique(width)):
        which = np.flatnonzero(width == w)
        own = off[which].astype(np.uint64)
        packed = pack_bits(own & np.uint64((1 << w) - 1), w)
        high = (own >> np.uint64(w)).astype("<u4")
        for k, b in enumerate(which):
            odd = np.flatnonzero(high[k])
            parts[b] = HEAD.pack(int(low[b]), w, len(odd)) + packed[k].tobytes() + odd.astype(np.uint8).tobytes() + high[k, odd].tobytes()
    head = len(MAGIC) + 8 + 8 * (blocks + 1)
    starts = head + np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    return MAGIC + struct.pack("<II", n, blocks) + starts.astype("<u8").tobytes() + b"".join(parts)


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts``, one row a block; blocks of one width are unpacked together."""
    raw = np.frombuffer(data, np.uint8)
    starts = starts.astype(np.int64)
    heads = raw[starts[:, None] + np.arange(HEAD.size)]
    low = heads[:, :4].copy().view("<u4").ravel().astype(np.uint64)
    width, odd = heads[:, 4].astype(np.int64), heads[:, 5:7].copy().view("<u2").ravel().astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint64)
    for w in map(int, np.unique(width)):
        which = np.flatnonzero(width == w)
        out[which] = unpack_bits(raw[(starts[which] + HEAD.size)[:, None] + np.arange(w * BLOCK // 8)], w)
    row = np.repeat(np.arange(len(starts)), odd)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(odd) - odd, odd)
    lists = starts + HEAD.size + width * BLOCK // 8
    where = raw[lists[row] + nth].astype(np.int64)
    high = raw[(lists[row] + odd[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").ravel().astype(np.uint64)
    out[row, where] |= high << width[row].astype(np.uint64)
    return (out + low[:, None]).astype(np.uint32)


def block_starts(data: bytes) -> tuple[int, np.ndarray]:
    """Number of ids, and where each block starts (one more entry: the end)."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of token blocks")
    n, blocks = struct.unpack_from("<II", data, 4)
    return n, np.frombuffer(data, "<u8", blocks + 1, 12)


def unpack(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a segment; only the blocks that hold them are read."""
    n, starts = block_starts(data)
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    begin, end = first // BLOCK, -(-last // BLOCK)
    ids = unpack_blocks(data, starts[begin:end]).ravel()
    return ids[first - begin * BLOCK : last - begin * BLOCK]


class LibraryEncoder(ChunkCache):
    """Chunks as the tokenizers library encodes them, many in one text; where each ends is told by the bytes that its tokens stand for."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        #: bytes of text that each token stands for; no token of the vocabulary reaches over white space
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.widths = np.zeros(max([*vocabulary.values(), *self.added.values()], default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            self.widths[i] = len(token.removesuffix(END_OF_WORD))
        for token, i in self.added.items():
            self.widths[i] = len(token.encode())

    def ask(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_chunks(self, new: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(new), AT_ONCE):
            group = new[at : at + AT_ONCE]
            ids = self.ask([" ".join(group)])[0]
            ends, reached = np.cumsum([len(c.encode()) for c in group]), np.cumsum(self.widths[ids])
            last = np.searchsorted(reached, ends)  # the token that each chunk ends with
            if not len(ids) or reached[-1] != ends[-1] or (reached[last] != ends).any():
                out += [own.tobytes() for own in self.ask(group)]
                continue
            bounds = [0, *(4 * (last + 1)).tolist()]
            packed = ids.tobytes()
            out += [packed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return out

    def encode_special(self, text: str) -> bytes:
        return self.ask([text])[0].tobytes()


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_blocks(docs: DataFrame, path: str, out: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into segments under ``out``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        held: list[bytes] = []
        ids: list[int | None] = []
        n = 0

        def flush() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(held), dtype="<u4"))
            lengths = [len(h) // 4 for h in held]
            columns = [[shard], [segment], [first], [n], [list(ids)], [lengths], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)],
                SEGMENTS.names,
            )

        for batch in slices(batches, ROWS_AT_ONCE, ENCODED_BYTES):
            for doc_id, encoded in zip(batch.column(0).to_pylist(), library_encoder(path).encode(batch.column(1).to_pylist()).to_pylist(), strict=True):
                ids.append(doc_id)
                held.append(encoded + end)
                n += len(encoded) // 4 + 1
                if n >= segment_ids:
                    yield flush()
                    segment, first, n = segment + 1, first + n, 0
                    held.clear()
                    ids.clear()
        if held:
            yield flush()

    rows = docs.select("doc_id", F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(out)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, read back from the segments: doc_id, start, n_tokens, token_ids (binary, with the end id)."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row a shard, that is, a write task: as many as the shuffle has partitions, a few bytes each
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("token_ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            ids = unpack(row["payload"]).astype("<u4")
            n = np.array(row["n_tokens"], dtype=np.int64)
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(n), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first_id"] + ends - n, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([ids[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)], pa.binary()),
                ],
                schema.names,
            )

    payloads = segments.select("shard", "first_id", "doc_ids", "n_tokens", "payload")
    return payloads.mapInArrow(run, schema).join(F.broadcast(shards), "shard").select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "token_ids")


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = new_path(spark, "token-blocks")
    write_blocks(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), out)
    return read_blocks(spark, out).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))
