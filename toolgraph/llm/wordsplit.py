"""Whole texts cut into white-space-free chunks, as a lower-casing word tokenizer sees them.

The tokenizer file's normaliser is NFC, white space to one space, lower case by
character; none of its pre-tokens holds white space, so a text's ids are its
chunks' ids one after the other. Chunks repeat, which is what the encoders'
caches live on.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode white space; str.split also splits at U+001C to U+001F, which are not
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: a run of marks at the end of a chunk, behind one of these characters, is a pre-token of its own
MARKS_AT_END = "([a-z0-9àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß])[.,;:!?]+$"
#: rows of one batch that are handled, and handed on, at once
SLICE = 1024


#: bytes of one batch that are handled at once, if that is fewer rows; numpy work on characters takes a hundred times as much memory
SLICE_BYTES = 1 << 21
#: the same for encoders, which look each chunk up once a slice
ENCODED_BYTES = 1 << 23


def cleaned(text: str) -> str:
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")  # by character, so without the final form of sigma
    return text.lower()


def chunks(text: str) -> list[str]:
    text = cleaned(text)
    if SEPARATORS.search(text):
        return [c for c in SPACE.split(text) if c]
    return text.split()


def distinct_chunks(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """The distinct chunks of some texts, which of them stands at each place, and at which place each text starts (one more entry)."""
    clean = [cleaned(t) for t in texts]
    if any(map(SEPARATORS.search, clean)):
        parts = [chunks(t) for t in texts]
        words = pa.array([c for p in parts for c in p], pa.large_string())
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    else:
        lists = pc.utf8_split_whitespace(pa.array(clean, pa.large_string()))
        words, starts = lists.flatten(), lists.offsets.to_numpy()
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), starts


class ChunkCache:
    """From chunk to ids as little-endian unsigned 32-bit integers. Subclasses say how chunks, and texts with an added token's string, are encoded."""

    added: dict[str, int]
    #: chunks that a worker remembers
    entries = 1_000_000

    def __init__(self) -> None:
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode_chunks(self, new: list[str]) -> list[bytes]:
        raise NotImplementedError

    def encode_special(self, text: str) -> bytes:
        raise NotImplementedError

    def look_up(self, distinct: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of chunks, asked for without the sentence marks at their end. What was not asked for during the last half of the cache is forgotten."""
        if len(self.recent) + len(distinct) > self.entries // 2:
            self.recent, self.older = {}, self.recent
        coded = pc.replace_substring_regex(distinct, MARKS_AT_END, "\\1").dictionary_encode()
        bare = coded.dictionary.to_pylist()
        found = list(map(self.recent.get, bare))
        missing = [k for k, f in enumerate(found) if f is None]
        for k in missing:
            found[k] = self.older.get(bare[k])
        new = [k for k in missing if found[k] is None]
        for k, ids in zip(new, self.encode_chunks([bare[k] for k in new]), strict=True):
            found[k] = ids
        self.recent.update((bare[k], found[k]) for k in missing)
        taken = pa.array(found, pa.large_binary()).take(coded.indices)
        sizes = pc.binary_length(coded.dictionary).take(coded.indices)
        marked = pc.greater(pc.binary_length(distinct), sizes)
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        ends = [c.encode()[n:].decode() for c, n in zip(distinct.take(pa.array(at)).to_pylist(), sizes.to_numpy()[at].tolist(), strict=True)]
        marks = list(set(ends))
        of_marks = dict(zip(marks, self.encode_chunks(marks), strict=True))
        ends = pa.array([of_marks[e] for e in ends], pa.large_binary())
        return pc.replace_with_mask(taken, marked, pc.binary_join_element_wise(taken.filter(marked), ends, pa.scalar(b"", pa.large_binary())))

    def encode(self, texts: list[str | None]) -> pa.Array:
        """Ids of whole texts, packed; null is empty. Every distinct chunk of the texts is looked up once."""
        special = [k for k, t in enumerate(texts) if t and any(a in t for a in self.added)]
        plain = [t or "" for t in texts]
        for k in special:
            plain[k] = ""
        distinct, codes, starts = distinct_chunks(plain)
        taken = self.look_up(distinct).take(pa.array(codes))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(codes) + 1] if len(codes) else np.zeros(1, np.int64)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends[starts]), taken.buffers()[2]])
        if not special:
            return whole.cast(pa.binary())
        out = whole.to_pylist()
        for k in special:
            out[k] = self.encode_special(texts[k])
        return pa.array(out, pa.binary())


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows and about ``size`` bytes."""
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
