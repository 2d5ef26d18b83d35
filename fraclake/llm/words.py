"""Words of Arrow string batches as numpy arrays: one pass over the bytes, no Python loop per word.

A word is a run of bytes of a class. Classes that hold every byte from 0x80 on never cut a
character. A word becomes a 64-bit hash (a random multilinear form of its bytes, mixed),
so that windows, sets and counts are arithmetic on integer vectors. Arrays over bytes are
made for blocks of about a megabyte, cut between words; only eight bytes a word stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_every = np.ones(256, bool)
#: Everything but blank characters 0x09-0x0D and 0x20.
NOT_BLANK = _every.copy()
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, letters, and everything beyond ASCII.
ALPHANUMERIC = _every.copy()
ALPHANUMERIC[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
#: ASCII letters and everything beyond ASCII.
LETTERS = ALPHANUMERIC.copy()
LETTERS[0x30:0x3A] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int = 0) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


@dataclass
class Words:
    """Words of a batch: byte ranges [start, end), hashes, and the first word of each row (one more at the end)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row: np.ndarray

    def text(self, i: int, n: int = 1) -> tuple[bytes, ...]:
        return tuple(self.data[self.start[k]:self.end[k]].tobytes() for k in range(i, i + n))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and len + 1 offsets into them; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


_weights = [keys(64, 1)]


def _hash_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, which lie one after another with gaps."""
    lengths = end - start
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    if (longest := int(lengths.max())) > len(_weights[0]):
        _weights[0] = keys(2 * longest, 1)
    taken = data[inside + np.repeat(start, lengths)].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(_weights[0][inside] * taken, first) + lengths.astype(np.uint64))


def words(column: pa.Array, kind: np.ndarray, lower: bool = False) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, hashes = [], [], []
    lo = 0
    while lo < len(data):
        hi = min(len(data), lo + BLOCK)
        if hi < len(data):  # a block that ends inside a word goes on to the word's end
            row_end = int(offsets[np.searchsorted(offsets, hi)])
            while hi < row_end and kind[data[hi]]:
                gap = np.flatnonzero(~kind[data[hi:min(hi + BLOCK, row_end)]])
                hi = hi + int(gap[0]) if len(gap) else min(hi + BLOCK, row_end)
        inside = kind[data[lo:hi]]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        begins, stops = edge[:-1] == 1, edge[1:] == -1
        rows = offsets[(offsets > lo) & (offsets < hi)] - lo  # a word ends with its row
        begins[rows] |= inside[rows]
        stops[rows - 1] |= inside[rows - 1]
        begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        if len(begin):
            hashes.append(_hash_runs(data[lo:hi], begin, stop))
            starts.append(begin + lo)
            ends.append(stop + lo)
        lo = hi
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    code = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return Words(data, start, end, code, np.searchsorted(start, offsets))


def windows(code: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbours (rows are not told apart here)."""
    if len(code) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(code) - n + 1, np.uint64(n))
    for k, weight in enumerate(keys(n, 2 + n)):
        total += code[k:len(code) - n + 1 + k] * weight
    return mix(total)


def window_rows(row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window position whether it lies in one row, given the first word of each row."""
    total = int(row[-1])
    ends = np.repeat(row[1:], np.diff(row))
    return np.arange(total) + n <= ends, ends


def in_slices(batch: pa.RecordBatch, column: str, limit: int = 2 * BLOCK) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about ``limit`` bytes of text, but one row at least."""
    for lo, hi in cuts(batch.column(column), limit):
        yield batch.slice(lo, hi - lo)


def cuts(column: pa.Array, limit: int = 2 * BLOCK) -> Iterator[tuple[int, int]]:
    _, offsets = text_bytes(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi
