"""Words and word n-grams of whole texts as 64-bit hashes, a piece of a batch at a time.

Texts are read as UTF-8 bytes. A word is a run of bytes of one class, so a table of 256 entries
decides it; bytes from 0x80 on, which make up all characters beyond ASCII, are of one class.
Hashes of words and n-grams come from sums of powers modulo 2^64, so that all positions of many
texts are hashed by a few array operations. An unlike pair of sequences agrees with a chance of
about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_R = 0x9E3779B97F4A7C15 | 3  # odd, 3 modulo 4


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, as many as any piece has asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES + 1)
            self.up, self.down = _powers(_R, size), _powers(pow(_R, -1, 2**64), size)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()

#: Bytes that are no word: white space of ASCII.
SPACE = np.ones(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every pair of bounds."""
    up, down = _POWERS.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, bounds of rows) of whole texts that add up to ``size`` or so.

    Null is read as empty.
    """
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.binary())
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def find_words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends of words, and for every row the number of the first word at or after it."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    begins = inside & ~before
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] |= inside[edges]
    ends = before & ~inside
    ends[edges] |= before[edges]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, bounds)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    return run_hashes((_LOWER if lower else _BYTE)[data], starts, ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, across texts too: callers keep to one text."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    at = np.arange(len(words) - n + 1)
    return run_hashes(words, at, at + n)
