"""Texts cut where neither a byte-level nor a piece tokenizer ever joins: before white space that follows none.

A byte-level pre-token is white space, or an optional space and what is none, so
it never reaches from other characters into white space; and no piece of the
sentence-piece vocabulary holds a space behind another character. A text's ids
are therefore its chunks' ids one after the other, whatever stands around them.
Cuts are made at spaces and line feeds only.

Each distinct chunk of some texts is encoded once. Many chunks go as one text and
are told apart by the bytes of their tokens; the few that end in white space,
where the next chunk might join, are encoded alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: characters that can mark cuts in texts that do not hold them
MARKERS = "\x00\x01\x02\x03￿￾"
#: last bytes of white space beyond ASCII
SPACE_ENDS = {chr(c).encode()[-1] for c in range(0x80, 0x3001) if chr(c).isspace()}
#: chunks in one text for a library
AT_ONCE = 2048
#: fixed value: how a byte-level file without a pattern of its own splits texts
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_PIECE = "▁"


def buffers(chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings one after the other, and where each begins (one more entry)."""
    chunks = pa.concat_arrays([chunks])  # without an offset
    _, starts, data = chunks.buffers()
    starts = np.frombuffer(starts, np.int64)[: len(chunks) + 1] if len(chunks) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[: starts[-1]] if data is not None else np.zeros(0, np.uint8), starts


def ends_in_space(chunks: pa.LargeStringArray) -> np.ndarray:
    """Whether each string is empty or ends in white space."""
    data, starts = buffers(chunks)
    found = np.diff(starts) == 0
    last = np.full(len(chunks), 32, np.uint8)
    last[~found] = data[starts[1:][~found] - 1]
    found |= (last == 32) | ((last >= 9) & (last <= 13)) | ((last >= 28) & (last <= 31))
    for k in np.flatnonzero(last >= 128).tolist():
        found[k] = chunks[k].as_py()[-1].isspace() if last[k] in SPACE_ENDS else False
    return found


def cut(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """The distinct chunks of some texts, which of them stands at each place, and at which place each text starts (one more entry)."""
    marker = next((m for m in MARKERS if not any(m in t for t in texts)), None)
    if marker is None:
        lists = pa.array([CUT.split(t) if t else [] for t in texts], pa.large_list(pa.large_string()))
    else:
        marked = [t.replace(" ", marker + " ").replace("\n", marker + "\n") for t in texts]
        lists = pc.split_pattern(pa.array([m[m.startswith(marker) :] for m in marked], pa.large_string()), marker)
    coded = lists.flatten().dictionary_encode()
    return joined_spaces(coded.dictionary, coded.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64))


def joined_spaces(distinct: pa.LargeStringArray, codes: np.ndarray, starts: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Undo cuts behind white space, and drop empty chunks (an empty text has one)."""
    open_end = ends_in_space(distinct)
    joins = open_end[codes]
    joins[starts[1:][np.diff(starts) > 0] - 1] = False  # the last chunk of a text
    empty = pc.index(distinct, pa.scalar("", pa.large_string())).as_py()
    keep = ~joins & (codes != empty)
    if keep.all():
        return distinct, codes, starts
    names = distinct.to_numpy(zero_copy_only=False).tolist()
    known: dict[str, int] = {}
    at = np.flatnonzero(joins)
    firsts = at[np.diff(at, prepend=-2) > 1]
    lasts = at[np.diff(at, append=len(codes) + 1) > 1] + 1
    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
        whole = "".join(names[k] for k in codes[a : b + 1].tolist())
        codes[b] = known.setdefault(whole, len(names) + len(known))
        keep[b] = True
    coded = pa.concat_arrays([distinct, pa.array(list(known), pa.large_string())]).take(pa.array(codes[keep])).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(keep)])[starts]


def gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the chunks that stand at each place, one after the other, and where each place's begin (one more entry)."""
    begins = np.cumsum(sizes) - sizes
    n = sizes[codes]
    ends = np.cumsum(n)
    source = np.repeat(begins[codes] - (ends - n), n)
    source += np.arange(len(source))
    return flat[source], np.concatenate([[0], ends])


class Library:
    """A tokenizer library, with the bytes that each id stands for."""

    def __init__(self, token_bytes: list[bytes]):
        self.width_of = np.array([len(b) for b in token_bytes], dtype=np.int64)
        self.offset_of = np.cumsum(self.width_of) - self.width_of
        self.buffer = np.frombuffer(b"".join(token_bytes), np.uint8)

    def ask(self, text: str) -> np.ndarray:
        """Ids of a text that stands alone."""
        raise NotImplementedError

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return gathered(self.buffer, self.width_of, ids)[0].tobytes()

    def encode_chunks(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after the other, and how many each has."""
        data, starts = buffers(chunks)
        first = data[starts[:-1]]
        alone = ends_in_space(chunks) | ((first != 32) & (first != 10))
        order = [np.flatnonzero(~alone)]
        data, starts = buffers(chunks.filter(pa.array(~alone))) if alone.any() else (data, starts)
        parts, sizes = [], []
        for at in range(0, len(starts) - 1, AT_ONCE):
            own = starts[at : at + AT_ONCE + 1]
            text = data[own[0] : own[-1]].tobytes().decode()
            ids = self.ask(text)
            ends = np.cumsum(self.width_of[ids])
            stops = np.searchsorted(ends, own[1:] - own[0])
            if stops[-1] != len(ids) - 1 or (ends[stops] != own[1:] - own[0]).any():  # some chunk's ids do not spell it
                each = [self.ask(data[a:b].tobytes().decode()) for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                parts += each
                sizes.append(np.array([len(e) for e in each]))
            else:
                parts.append(ids)
                sizes.append(np.diff(stops, prepend=-1))
        if alone.any():
            order.append(np.flatnonzero(alone))
            each = [self.ask(c) for c in chunks.filter(pa.array(alone)).to_pylist()]
            parts += each
            sizes.append(np.array([len(e) for e in each]))
        flat, n = np.concatenate([*parts, np.zeros(0, np.uint32)]), np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
        if not alone.any():
            return flat, n
        at = np.empty(len(chunks), np.int64)
        at[np.concatenate(order)] = np.arange(len(chunks))
        return gathered(flat, n, at)[0], n[at]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after the other, and where each text's begin (one more entry)."""
        distinct, codes, starts = cut(texts)
        ids, begins = gathered(*self.encode_chunks(distinct), codes)
        return ids, begins[starts]


class ByteLevel(Library):
    """A byte-level BPE file of the tokenizers library, whose ids stand in the order of their merges. Its ids come from the faster tiktoken, which gets the same vocabulary.

    ``plain_special``: strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, symbols: dict[str, int], plain_special: bool):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(symbols[c] for c in name): i for name, i in spec["model"]["vocab"].items() if name not in special}
        self.library = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special: set[str] = set() if plain_special else set(special)
        names = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        super().__init__([names[i] for i in range(len(names))])

    def ask(self, text: str) -> np.ndarray:
        return self.library.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())


class Pieces(Library):
    """A sentence-piece model that adds a space. A chunk is encoded behind a line feed, which no piece holds, so that none is added to it."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any("\n" in p or SPACE_PIECE in p.lstrip(SPACE_PIECE) for p in pieces):
            raise ValueError("a piece holds a line feed, or a space behind another character: texts can't be cut")
        hex_byte = re.compile("<0x([0-9A-F]{2})>")
        super().__init__([bytes([int(m[1], 16)]) if (m := hex_byte.fullmatch(p)) else p.replace(SPACE_PIECE, " ").encode() for p in pieces])

    def ask(self, text: str) -> np.ndarray:
        return np.array(self.library.encode("\n" + text)[2:], dtype=np.uint32)


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of about ``size`` bytes, or one longer row."""
    held: list[pa.RecordBatch] = []
    weight = 0
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(1, batch.nbytes) / 4))
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            weight += held[-1].nbytes
            if weight >= size:
                yield pa.Table.from_batches(held)
                held, weight = [], 0
    if held:
        yield pa.Table.from_batches(held)
