"""Whole blocks of texts as arrays of bytes, words and word windows.

Words are ``[^\\x20\\x09-\\x0D]+``. The separators are single bytes of UTF-8 and
never part of a longer character, so words can be cut from the raw bytes of an
Arrow string column with a handful of array operations per block instead of a
Python loop per word.

Every word gets a 64-bit polynomial hash over its bytes (a random odd value per
byte, powers of an odd base, so prefix differences give any word's hash in
constant time), passed through a mixer; windows of words combine these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .workers import turn_to

U64 = np.uint64
BLOCK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd, 5 modulo 8
_WINDOW = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply, shift, multiply, shift)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_values(stream: int, lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * U64(0xA24BAED4963EE407) + U64(stream)) | U64(1)
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    return values


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as long as the longest block so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, U64(base))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


@dataclass
class Grid:
    """Words of a block of texts: byte offsets, the text each belongs to, and each text's first word."""

    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.first) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def span_hashes(self, start: np.ndarray, end: np.ndarray, stream: int = 0, lower: bool = False) -> np.ndarray:
        """A mixed 64-bit hash of the bytes start[i]:end[i]; ``lower`` folds A-Z to a-z."""
        up, down = _powers.upto(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(_byte_values(stream, lower)[self.data] * up[:-1], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start])

    def word_hashes(self, stream: int = 0, lower: bool = False) -> np.ndarray:
        return self.span_hashes(self.start, self.end, stream, lower)

    def count(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flagged bytes each text has."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.text_at[1:]] - sums[self.text_at[:-1]]

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of k words within one text, and the word each starts at."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        out = hashes[:n].copy()
        for j in range(1, k):
            out = out * _WINDOW + hashes[j : n + j]
        inside = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        return mix(out[inside] + U64(k)), inside

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.text_at[i] : self.text_at[i + 1]].tobytes()


def grid_of(texts: pa.Array) -> Grid:
    """The grid of an Arrow string array; null counts as an empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    in_word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    opens = np.zeros(len(raw) + 1, bool)
    opens[at] = True  # a text's first byte never continues the text before
    before = np.concatenate(([False], in_word[:-1])) if len(raw) else in_word
    start = np.flatnonzero(in_word & (~before | opens[:-1]))
    after = np.concatenate((in_word[1:], [False])) if len(raw) else in_word
    end = np.flatnonzero(in_word & (~after | opens[1:])) + 1
    first = np.searchsorted(start, at)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Grid(raw, at, start, end, text, first)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of text each, or one longer text."""
    turn_to("grid")
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        block = np.cumsum(sizes + 16) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def per_text(values: np.ndarray, at: np.ndarray, ufunc: np.ufunc, empty: int = 0) -> np.ndarray:
    """``ufunc`` over the values of each text; ``at`` has n + 1 bounds, an empty text gives ``empty``."""
    out = np.full(len(at) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = ufunc.reduceat(values, at[:-1][full])
    return out


def long_lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """An Arrow array<long> column with values[at[i]:at[i+1]] in row i."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))
