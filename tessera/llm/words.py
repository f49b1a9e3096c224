"""Words, hashes and per-document counts, computed with numpy on the UTF-8
bytes of an Arrow string column.

A *word* is a maximal run of bytes outside space and 0x09-0x0D; UTF-8 never
uses these bytes inside a longer character, so bytes and code points agree.
Texts are handled whole, a few megabytes of them at a time, which bounds the
memory of a task whatever the batch size is.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.RandomState(20240817)
_TABLE = _rng.randint(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _powers:
        pw = np.full(_BLOCK, _P, np.uint64)
        pw[0] = 1
        iv = np.full(_BLOCK, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)
        iv[0] = 1
        with np.errstate(over="ignore"):
            _powers["p"], _powers["i"] = np.cumprod(pw), np.cumprod(iv)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


class Spans:
    """Prefix sums of byte values, from which any span's hash follows at once."""

    def __init__(self, data: np.ndarray):
        p, _ = _power_tables()
        self.data = data
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            for at in range(0, len(data), _BLOCK):
                part = _TABLE[data[at:at + _BLOCK]]
                part *= p[:len(part)]
                self.sums[at + 1:at + 1 + len(part)] = part
            np.cumsum(self.sums, out=self.sums)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of data[start:end]; a function of the bytes alone."""
        p, inv = _power_tables()
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[start]) * inv[start % _BLOCK]
            for i in np.flatnonzero((start // _BLOCK) != (np.maximum(end, start + 1) - 1) // _BLOCK):
                part = _TABLE[self.data[start[i]:end[i]]]
                h[i] = (part * np.resize(p, len(part))).sum(dtype=np.uint64)
        return mix(h)


@dataclass
class Chunk:
    """Consecutive rows of one column: ``data`` holds the bytes, ``offsets`` the row borders."""
    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Chunk:
        return Chunk(self.first, _LOWER[self.data], self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first): word i spans data[starts[i]:ends[i]]; row r has words first[r]:first[r+1]."""
        b, off = self.data, self.offsets
        if not len(b):
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.rows + 1, np.int64)
        space = IS_SPACE[b]
        edge = np.empty(len(b), bool)
        edge[0], edge[1:] = True, space[:-1]
        edge[off[off < len(b)]] = True
        starts = np.flatnonzero(edge & ~space)
        edge[-1], edge[:-1] = True, space[1:]
        inner = off[(off > 0)] - 1
        edge[inner] = True
        ends = np.flatnonzero(edge & ~space) + 1
        return starts, ends, np.searchsorted(starts, off)

    def per_row(self, flag: np.ndarray) -> np.ndarray:
        """Number of set flags (one per byte) in each row."""
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def text_chunks(column, max_bytes: int = _BLOCK) -> Iterator[Chunk]:
    """The column's rows in order, about ``max_bytes`` of text at a time; a longer text comes alone and whole."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Chunk(at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of every item, from the borders ``first``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def per_row_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the items of each row."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def sum_by_row(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sum of ``values`` by row number, each row summed on its own."""
    return np.bincount(row, weights=values, minlength=rows)
