"""Words of whole texts as hashes, computed over the bytes of an Arrow batch.

A word is a run of bytes other than the six ASCII blanks (space and 0x09-0x0D),
which in UTF-8 is the same as ``[^\\x20\\x09-\\x0D]+`` over code points. The hash
of a word is a polynomial over its bytes, taken from running sums, so that no
Python loop touches a word. Texts are worked through in pieces that end at a
blank; memory follows the piece, not the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at a time.
PIECE_BYTES = 1 << 18

#: Bytes of text in one group of rows handed to a kernel; one longer text may exceed it.
GROUP_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words(NamedTuple):
    """Words of several texts in order: text number, byte range and hash of each."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def first(self, n_texts: int) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.searchsorted(self.text, np.arange(n_texts + 1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _byte_values(seed: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
    base = int(rng.integers(0, 1 << 61)) * 8 + 5
    return values, base, pow(base, -1, 1 << 64)


@lru_cache(maxsize=16)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _power_of(base: int, n: int) -> np.ndarray:
    size = PIECE_BYTES
    while size < n:
        size *= 2
    return _powers(base, size)[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins; null is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, seed: int = 1) -> Words:
    """All words of the texts."""
    data, offsets = text_bytes(texts)
    solid = ~_BLANK[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(text, start, end, word_hashes(data, start, end, seed), data, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order and do not overlap."""
    values, base, inverse = _byte_values(seed)
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            low = int(start[at])
            upto = max(at + 1, int(np.searchsorted(end, low + PIECE_BYTES, side="right")))
            high = int(end[upto - 1])
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(values[data[low:high]] * _power_of(base, high - low), out=sums[1:])
            s, e = start[at:upto] - low, end[at:upto] - low
            raw = (sums[e] - sums[s]) * _power_of(inverse, high - low)[s]
            out[at:upto] = mix(raw + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            at = upto
    return out


def window_hashes(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes, in order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    odd = np.random.default_rng([seed, size]).integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out += mix(hashes[k : k + n] + odd[k]) if k == 0 else hashes[k : k + n] * odd[k]
    return mix(out)


def text_windows(words: Words, n_texts: int, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window that lies within one text, and the index of its first word."""
    hashes = window_hashes(words.hash, size, seed)
    within = words.text[: len(hashes)] == words.text[size - 1 :] if len(hashes) else np.zeros(0, bool)
    at = np.flatnonzero(within)
    return hashes[at], at


def row_groups(batches: Iterator[pa.RecordBatch], text: str, limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about ``limit`` bytes together."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        sizes = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        low = 0
        while low < batch.num_rows:
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(low, high - low)
            low = high
