"""Words of Arrow text columns as numpy arrays.

Works on the UTF-8 bytes of a whole batch: a word is a maximal run of bytes
other than 0x20 and 0x09-0x0D inside one row. Word hashes are 64-bit
polynomials, finalised with a bijective mixer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        grown = max(n, 1 << 16)
        tables = []
        for base in (_BASE, _INVERSE):
            t = np.full(grown, base, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        if grown > 1 << 23:  # a single very long text: don't hold on to its tables
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes in one array, and row offsets; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.add(data, np.uint64(1), out=sums[1:], dtype=np.uint64)
    sums[1:] *= power[:n]
    np.cumsum(sums[1:], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def split_counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of true positions in each row's range."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


@dataclass
class Words:
    """All words of a batch, in order. row_offsets has the first word of each row."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row_offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row_offsets)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row_offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = flat_bytes(column)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    edges = edges[edges > 0] - 1
    last[edges] = inside[edges]
    starts = np.flatnonzero(first)
    return Words(data, offsets, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each position (len - k + 1 values)."""
    n = max(0, len(hashes) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += hashes[i : i + n]
    return mix(total)


def whole_grams(row_offsets: np.ndarray, k: int, total: int) -> np.ndarray:
    """Mask of the start positions whose k words all lie in one row."""
    n = max(0, total - k + 1)
    mask = np.ones(n, bool)
    ends = row_offsets[1:-1]
    for back in range(1, k):
        at = ends - back
        mask[at[(at >= 0) & (at < n)]] = False
    return mask
