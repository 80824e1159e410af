"""Vectorised splitting and hashing of words in Arrow batches.

A word is a run of bytes outside `[\\x20\\x09-\\x0D]`. Work goes over slices of about a megabyte of
text, so memory follows the slice (or one longer document), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE_BYTES = bytes([9, 10, 11, 12, 13, 32])
SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        n = max(n, 2 * SLICE_BYTES)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        if n > 16 * SLICE_BYTES:
            return tuple(tables)  # one very long document; not kept
        _powers = tuple(tables)
    return _powers


@dataclass
class Words:
    """Words of a slice of documents: `bounds[i]:bounds[i + 1]` are those of document i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        """One 64-bit value per word, by its bytes."""
        power, inverse = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[self.data] * power[: len(self.data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _IS_SPACE) -> Words:
    """Runs of bytes that `gap`, a flag per byte, does not mark; a run never crosses an offset."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(offsets), np.int64))
    space = gap[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    after = np.empty_like(space)
    after[-1], after[:-1] = True, space[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def slices(table: pa.RecordBatch | pa.Table, column: str, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `size` bytes of text each; a longer document is a range of its own."""
    lengths = pc.fill_null(pc.binary_length(table[column]), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False) if isinstance(lengths, pa.Array) else lengths.to_numpy())
    start, done = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def row_offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each pair, one after the other."""
    total = int(counts.sum())
    first = np.repeat(starts - row_offsets(counts)[:-1], counts)
    return first + np.arange(total)
