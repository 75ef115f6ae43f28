"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

The encoder never replays merges. An Aho-Corasick automaton over the vocabulary
gives the longest token at a position; a token may follow another only if the
two are compatible, that is, if undoing their merges step by step never shows a
pair at their seam that would have merged earlier than what was undone. When no
prefix of the match is compatible, the previous token is shortened instead; a
position that failed once is never tried again, so the work is linear in the
word. The result equals exact BPE. Words repeat, so each Python worker keeps a
bounded cache from chunk to ids.

The decoder holds all token strings in one buffer with their offsets, and
gathers a batch of id sequences from it without a loop over tokens.

Defined results: null text encodes as empty (no ids, empty decoded text, n_tokens
0). The added tokens' strings inside a text are those tokens. Only the id and
text columns are read, so clashing extra columns do not matter; repeated rows
give repeated results; an empty table gives an empty one. Texts are encoded
whole, whatever their length.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolgraph.llm.wordsplit import ENCODED_BYTES, ChunkCache, chunks, slices

END_OF_WORD = "</w>"
#: bytes of text that are encoded and decoded at once
ROUND_TRIP_BYTES = 1 << 22
#: token pairs whose compatibility a worker remembers before it starts anew
PAIR_ENTRIES = 250_000


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary: printable bytes are themselves, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of one tokenizer file (word-final BPE over bytes, ids of merged tokens in merge order)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        names = [""] * size
        for name, i in [*ids.items(), *self.added.items()]:
            names[i] = name
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None

        symbols = byte_symbols()
        keys: dict[str, int] = {}
        for name, i in ids.items():
            final = name.endswith(END_OF_WORD)
            codes = [symbols[c] for c in (name.removesuffix(END_OF_WORD) if final else name)]
            if final:
                codes[-1] += 256
            keys["".join(map(chr, codes))] = i
        self.length = [0] * size
        for key, i in keys.items():
            self.length[i] = len(key)
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = ids[a + b]
            self.left[whole], self.right[whole] = ids[a], ids[b]
            self.merged[ids[a], ids[b]] = whole
        self.matches = ahocorasick.Automaton()
        for key, i in keys.items():
            self.matches.add_word(key, i)
        self.matches.make_automaton()
        #: the longest token that is a proper prefix of a token
        self.shorter: list[int] = [-1] * size
        for key, i in keys.items():
            for n in range(len(key) - 1, 0, -1):
                if (at := keys.get(key[:n])) is not None:
                    self.shorter[i] = at
                    break
        self._compatible: dict[int, bool] = {}

        spaced = [name.encode() + b" " for name in names]
        self.text_of = np.frombuffer(b"".join(spaced), dtype=np.uint8)
        self.width_of = np.array([len(x) for x in spaced], dtype=np.int64)
        self.offset_of = np.concatenate([[0], np.cumsum(self.width_of)])[:-1]

    def compatible(self, a: int, b: int) -> bool:
        """Whether exact BPE can leave ``a`` and ``b`` side by side."""
        pair = a * len(self.left) + b
        known = self._compatible.get(pair)
        if known is None:
            if len(self._compatible) >= PAIR_ENTRIES:
                self._compatible.clear()
            known = self._compatible[pair] = self._seam_holds(a, b)
        return known

    def _seam_holds(self, a: int, b: int) -> bool:
        undone = len(self.left) + 1  # merges from this id on had not happened yet
        while True:
            whole = self.merged.get((a, b))
            if whole is not None and whole < undone:
                return False
            can_a, can_b = self.right[a] != a, self.left[b] != b
            if not can_a and not can_b:
                return True
            # undo whichever of the two was merged later
            if can_a and (a > b or not can_b):
                undone, a = a, self.right[a]
            else:
                undone, b = b + 1, self.left[b]

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        word = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        end, length, shorter, compatible = len(word), self.length, self.shorter, self.compatible
        longest = lambda at: next(self.matches.iter_long(word, at))[1]
        found: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest(0)
        while at < end:
            stop = at + length[token]
            if stop not in dead and (not found or compatible(found[-1], token)):
                found.append(token)
                at = stop
                if at < end:
                    token = longest(at)
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead.add(at)
                token = found.pop()
                at -= length[token]
        return found

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts of id sequences that follow each other in ``ids`` (``starts`` has one more entry): bytes, and their offsets."""
        widths = self.width_of[ids]
        ends = np.cumsum(widths)
        total = int(ends[-1]) if len(ids) else 0
        source = np.repeat(self.offset_of[ids] - (ends - widths), widths)
        source += np.arange(total)
        text = self.text_of[source]
        bounds = np.concatenate([[0], ends])[starts]
        keep = np.ones(total, dtype=bool)  # no space after the last token of a sequence
        full = np.diff(starts) > 0
        keep[bounds[1:][full] - 1] = False
        return text[keep], np.concatenate([[0], np.cumsum(np.diff(bounds) - full)])


class Encoder(ChunkCache):
    """Exact BPE of chunks by backtracking."""

    entries = 400_000

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.added = vocabulary, vocabulary.added

    def encode_chunks(self, new: list[str]) -> list[bytes]:
        pieces, encode = self.vocabulary.pattern.findall, self.vocabulary.encode_piece
        return [np.array([i for piece in pieces(c) for i in encode(piece)], dtype="<u4").tobytes() for c in new]

    def encode_special(self, text: str) -> bytes:
        parts = self.vocabulary.split_added.split(text)
        return b"".join(self.added[p].to_bytes(4, "little") if k % 2 else b"".join(self.encode_chunks(chunks(p))) for k, p in enumerate(parts))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long, token_ids binary: little-endian unsigned 32-bit ids) of every text."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))  # a task's own, so that idle workers hold no chunks
        for batch in slices(batches, size=ENCODED_BYTES):
            ids = encoder.encode(batch.column(1).to_pylist())
            n = pc.divide(pc.binary_length(ids).cast(pa.int64()), 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), n, ids], [id_col, "n_tokens", "token_ids"])

    return rows.mapInArrow(run, schema)


def decoded_texts(table: Vocabulary, packed: list[bytes | None]) -> pa.Array:
    """Texts of packed ids."""
    packed = [x or b"" for x in packed]
    starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int64)
    text, offsets = table.decode(np.frombuffer(b"".join(packed), dtype="<u4"), starts)
    return pa.LargeStringArray.from_buffers(len(packed), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())


def decode(encoded: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Adds ``decoded``: the tokens' strings joined by a space, as the library's decode without a decoder gives them."""
    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded_texts(table, batch.column(names.index(ids_col)).to_pylist())], names)

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decoded) of every text: :func:`encode` and :func:`decode` in one pass, so that a task has one worker with one vocabulary."""
    rows = docs.select("doc_id", F.col("text").cast("string"))
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in slices(batches, size=ROUND_TRIP_BYTES):
            ids = encoder.encode(batch.column(1).to_pylist())
            n = pc.divide(pc.binary_length(ids).cast(pa.int64()), 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), n, ids, decoded_texts(encoder.vocabulary, ids.to_pylist())], schema.names)

    return rows.mapInArrow(run, schema)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    return round_trip(docs, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
