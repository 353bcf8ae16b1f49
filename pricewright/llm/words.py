"""Words, shingles and windows of many texts at once, as arrays of 64-bit hashes.

A word is a maximal run of bytes other than ASCII white space (space, tab to
carriage return). White space is ASCII, so UTF-8 bytes can be cut directly. All
work is on whole Arrow columns; nothing here loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WHITE = " \t\n\x0b\x0c\r"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(sign) for sign in WHITE]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits (a bijection)."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` to the 0, 1, ... and its inverse to the same, modulo 2 to the 64."""
    known = _TABLES.get(base)
    if known is None or len(known[0]) < count:
        size = 1 << max(16, (count - 1).bit_length())
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor & _MASK, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        known = _TABLES[base] = (tables[0], tables[1])
    return known


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for each pair, which does not depend on where the span lies."""
    powers, inverses = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers[:len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of consecutive texts: bounds in ``data``, and ``first[i]:first[i + 1]`` for text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        size = len(data)
        solid = ~_SPACE[data]
        borders = offsets[offsets < size]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        begins[borders] = solid[borders]
        stops = solid.copy()
        stops[:-1] &= ~solid[1:]
        before = borders[borders > 0] - 1
        stops[before] = solid[before]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, base: int = _BYTE_BASE) -> np.ndarray:
        """A hash of each word; those of two (odd) bases are independent of each other."""
        return span_hashes(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, base)

    def grams(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words inside one text, and the word each begins at."""
        counts = np.diff(self.first)
        fits = np.maximum(counts - size + 1, 0)
        at = np.repeat(self.first[:-1] - np.cumsum(fits) + fits, fits) + np.arange(fits.sum())
        return span_hashes(hashes, at, at + size, _WORD_BASE), at

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (without it) joined by single spaces."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[first:last], self.ends[first:last], strict=True))


def pieces_of(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into slices of at most ``most`` bytes, or one text: row, bytes, offsets.

    Null counts as empty.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    count = len(column)
    if not count:
        return
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, dtype=np.int64)[column.offset:column.offset + count + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < count:
        last = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        last = min(count, max(row + 1, last))
        yield row, raw[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row]
        row = last
