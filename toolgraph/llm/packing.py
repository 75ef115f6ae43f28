"""Bounded-space online packing of token sequences.

Each task encodes its documents, appends the end id, and packs them as they
come. A document's full windows are sequences of their own; what is left is one
piece, which goes to the fullest of the open windows that has room (best fit).
When none has, the fullest is filled up with the head of the piece and emitted,
and the rest opens a window; so a task never holds more than ``open_windows``
windows, wherever it is in its input, and what it emits before its end has no
padding. At its end it merges its own leftovers: the least full windows are
poured into the fullest, until one partial window is left.

The partial windows, one a task, are then merged in rounds of ``fan_in`` tasks
by the same packer. The last one is cut at powers of two, which need no padding.

Defined results: null text is empty, so a document has at least its end id. Rows
whose doc_id is null or repeats are documents of their own, told apart by
``document`` (input partition and place in it). Other columns are ignored. An
empty table gives an empty result. Long texts are encoded chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.bpe import byte_symbols
from toolgraph.llm.cuts import ByteLevel, blocks
from toolgraph.scratch import materialize

WINDOW = 1024
OPEN_WINDOWS = 32
FAN_IN = 512
#: bytes of text that are encoded at once
BLOCK_BYTES = 3 << 22
END_ID = 0
#: a piece as it is held: (doc_id, document, start, length, doc_tokens, ids)
Piece = tuple[object, int, int, int, int, bytes]


def head_and_rest(piece: Piece, n: int) -> tuple[Piece, Piece]:
    doc_id, document, start, length, doc_tokens, ids = piece
    return (doc_id, document, start, n, doc_tokens, ids[: 4 * n]), (doc_id, document, start + n, length - n, doc_tokens, ids[4 * n :])


class Packer:
    """Open windows of one task; full ones leave as lists of pieces."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.most = window, open_windows
        self.free: list[int] = []
        self.held: list[list[Piece]] = []

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Emit what becomes full."""
        while piece[3] >= self.window:
            full, piece = head_and_rest(piece, self.window)
            yield [full]
        if not piece[3]:
            return
        fits = [(f, k) for k, f in enumerate(self.free) if f >= piece[3]]
        if fits:
            k = min(fits)[1]
            self.held[k].append(piece)
            self.free[k] -= piece[3]
        elif len(self.free) < self.most:
            self.held.append([piece])
            self.free.append(self.window - piece[3])
            return
        else:
            k = self.free.index(min(self.free))
            head, rest = head_and_rest(piece, self.free[k])
            yield [*self.held[k], head]
            self.held[k], self.free[k] = [rest], self.window - rest[3]
            return
        if not self.free[k]:
            self.free.pop(k)
            yield self.held.pop(k)

    def merge_leftovers(self) -> Iterator[list[Piece]]:
        """Pour the least full windows into the fullest, until one is left."""
        order = sorted(range(len(self.free)), key=lambda k: (self.free[k], k))
        held, free = [self.held[k] for k in order], [self.free[k] for k in order]
        while len(held) > 1:
            piece = held[-1].pop()
            if piece[3] > free[0]:
                head, rest = head_and_rest(piece, free[0])
                held[0].append(head)
                held[-1].append(rest)
                free[-1] += free[0]
                free[0] = 0
            else:
                held[0].append(piece)
                free[0] -= piece[3]
                free[-1] += piece[3]
            if not held[-1]:
                held.pop()
                free.pop()
            if not free[0]:
                free.pop(0)
                yield held.pop(0)
        self.held, self.free = held, free


def in_powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """A partial window as sequences whose lengths are the powers of two that sum up to its own."""
    pieces = list(pieces)
    left = sum(p[3] for p in pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        own: list[Piece] = []
        while room:
            piece = pieces.pop(0)
            if piece[3] > room:
                piece, rest = head_and_rest(piece, room)
                pieces.insert(0, rest)
            own.append(piece)
            room -= piece[3]
        yield own


def piece_schema(doc_id: T.DataType) -> T.StructType:
    longs = ["document", "start", "length", "doc_tokens", "sequence_id", "offset"]
    return T.StructType(
        [T.StructField("doc_id", doc_id), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("token_ids", T.BinaryType()), T.StructField("task", T.LongType()), T.StructField("partial", T.BooleanType())]
    )


class Rows:
    """Sequences as rows of pieces."""

    def __init__(self, task: int, first_id: int, doc_id: pa.DataType):
        self.task, self.next_id, self.doc_id = task, first_id, doc_id
        self.held: list[tuple] = []

    def add(self, pieces: list[Piece], partial: bool = False) -> None:
        offset = 0
        for doc_id, document, start, length, doc_tokens, ids in pieces:
            self.held.append((doc_id, document, start, length, doc_tokens, self.next_id, offset, ids, self.task, partial))
            offset += length
        self.next_id += 1

    def taken(self, names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*self.held, strict=True)) or [()] * len(names)
        self.held = []
        kinds = [self.doc_id, *[pa.int64()] * 6, pa.binary(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


@lru_cache(maxsize=1)
def library(path: str) -> ByteLevel:
    return ByteLevel(path, byte_symbols(), plain_special=False)


def packed_by_task(docs: DataFrame, path: str, window: int, open_windows: int, end_id: int) -> DataFrame:
    """Pieces of full sequences, and of each task's partial one."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    schema = piece_schema(rows.schema["doc_id"].dataType)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer, out, n = Packer(window, open_windows), None, 0
        for table in blocks(batches, BLOCK_BYTES):
            out = out or Rows(task, task << 32, table.schema.field(0).type)
            ids, starts = library(path).encode([t or "" for t in table.column(1).to_pylist()])
            raw = ids.astype("<u4").tobytes()
            for doc_id, a, b in zip(table.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                length = b - a + 1
                for full in packer.place((doc_id, (task << 40) + n, 0, length, length, raw[4 * a : 4 * b] + end)):
                    out.add(full)
                n += 1
            yield out.taken(schema.names)
        if out:
            for full in packer.merge_leftovers():
                out.add(full)
            for left in packer.held:
                out.add(left, partial=True)
            yield out.taken(schema.names)

    return rows.mapInArrow(run, schema)


def merged_leftovers(pieces: DataFrame, window: int, open_windows: int, fan_in: int, nth: int, last: bool) -> DataFrame:
    """One round: the partial windows of ``fan_in`` neighbouring tasks become full sequences and one partial window, or, in the last round, sequences of powers of two."""
    names = pieces.columns

    def run(key: tuple, table: pa.Table) -> pa.Table:
        task = key[0].as_py()
        packer, out = Packer(window, open_windows), Rows(task, (nth << 56) + (task << 32), table.schema.field("doc_id").type)
        for row in table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            for full in packer.place((row["doc_id"], row["document"], row["start"], row["length"], row["doc_tokens"], row["token_ids"])):
                out.add(full)
        for full in packer.merge_leftovers():
            out.add(full)
        for left in packer.held:
            for part in in_powers_of_two(left) if last else [left]:
                out.add(part, partial=not last)
        return pa.Table.from_batches([out.taken(names)])

    return pieces.withColumn("group", F.floor(F.col("task") / fan_in)).groupBy("group").applyInArrow(lambda key, table: run(key, table.drop_columns("group")), pieces.schema)


def pack(docs: DataFrame, path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, fan_in: int = FAN_IN) -> DataFrame:
    """One row a piece: doc_id, document, start, length, doc_tokens, sequence_id, offset, token_ids (little-endian unsigned 32-bit ids)."""
    packed = materialize(packed_by_task(docs, path, window, open_windows, end_id), "packed")
    width = (packed.filter("partial").agg(F.max("task")).first()[0] or 0) + 1
    done, partial, nth = packed.filter("NOT partial"), packed.filter("partial"), 0
    while True:
        width, nth = -(-width // fan_in), nth + 1
        merged = materialize(merged_leftovers(partial, window, open_windows, fan_in, nth, width == 1), "merged-leftovers")
        done, partial = done.union(merged.filter("NOT partial")), merged.filter("partial")
        if width == 1:
            return done.drop("task", "partial")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
