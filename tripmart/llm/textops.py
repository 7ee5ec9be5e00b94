"""Words and shingles of Arrow text columns as NumPy arrays.

Words are maximal runs of bytes other than space and 0x09-0x0D. They are hashed to 64 bits by a
polynomial over random byte values; nothing is truncated, and memory is bounded by cutting a batch into
slices of a few megabytes of text (a longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[SPACE] = 0
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed.

    Functions sent to tasks take what they refer to with them; tables that grew on the driver are left behind.
    """

    def __init__(self):
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(n, SLICE_BYTES + (1 << 16))
            for at, base in enumerate((_BASE, _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                self.tables[at] = np.cumprod(steps, dtype=np.uint64)
        return self.tables


_powers = _Powers()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows holding at most `most` bytes, or one longer row."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, len(texts))
        yield first, last, everything[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """Begin and end of each word in the bytes, its row, and the first word of each row (rows + 1 numbers)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        self.data, self.offsets, self.separators = data, offsets, separators
        rows = len(offsets) - 1
        if not len(data):
            self.begin = self.end = self.row = np.zeros(0, np.int64)
            self.first = np.zeros(rows + 1, np.int64)
            return
        word = ~separators[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        starts, ends = word.copy(), word.copy()
        starts[1:] &= ~word[:-1] | cut[1:-1]
        ends[:-1] &= ~word[1:] | cut[1:-1]
        self.begin = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, offsets)
        self.row = np.repeat(np.arange(rows), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of every word; with `lower`, A-Z count as a-z."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        power, inverse = _powers.upto(len(self.data))
        values = np.where(self.separators, np.uint64(0), _VALUES[lower])[self.data]
        values *= power[: len(self.data)]
        return mix(np.add.reduceat(values, self.begin) * inverse[self.begin])


def windows(hashes: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words inside one row, and the number of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = hashes[:n].copy()
    for step in range(1, size):
        value *= np.uint64(0xA0761D6478BD642F)
        value ^= value >> np.uint64(29)
        value += hashes[step : n + step]
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    return mix(value[at]), at


def shingle_sets(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows one after the other, and each row's first (rows + 1 numbers).

    A row with fewer than `size` words has its whole sequence as one shingle; a row without words has none.
    """
    values, at = windows(hashes, words.row, size)
    rows = len(words.first) - 1
    counts = np.diff(words.first)
    owner = words.row[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.empty(len(short), np.uint64)
        for k, row in enumerate(short):
            value, _ = windows(hashes[words.first[row] : words.first[row + 1]], np.zeros(counts[row], np.int64), counts[row])
            whole[k] = value[0] ^ np.uint64(counts[row])
        values, owner = np.concatenate([values, whole]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    first = np.searchsorted(owner, np.arange(rows + 1))
    for row in range(rows):
        values[first[row] : first[row + 1]].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(rows + 1))
