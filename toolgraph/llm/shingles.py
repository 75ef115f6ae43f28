"""Word and shingle hashes of whole Arrow text columns, without a loop over words.

A word is a run of ASCII letters (lower-cased), digits, underscores or any
non-ASCII characters. Word hashes come from prefix sums of a polynomial over
the bytes of the column, modulo 2**64, so a batch costs a few passes of numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = 0xD6E8FEB86659FD93
_letters = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    if _b >= 128 or _c.isalnum() or _c == "_":
        _letters[_b] = ord(_c.lower()) if _b < 128 else _b
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts (one more entry); null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and at which of them each text starts (one more entry)."""
    raw, offsets = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    codes = _letters[raw]
    inside = codes != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    first[heads] = inside[heads]
    begin = np.flatnonzero(first)
    forward, back = powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(np.multiply(codes, forward, out=sums[1:]), out=sums[1:])
    # other bytes add nothing, so a word's sum runs to where the next word begins
    ends = np.concatenate([begin[1:], [len(raw)]])
    hashes = mix((sums[ends] - sums[begin]) * back[begin] + np.uint64(STEP))
    return hashes, np.searchsorted(begin, offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of all words together if there are fewer; none if there are no words."""
    n = min(size, len(words))
    if n == 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(STEP) + words[j : len(words) - n + 1 + j]
    return mix(out)
