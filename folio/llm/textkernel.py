"""Vectorised tokenising and hashing of whole Arrow string columns.

The functions work on the UTF-8 bytes of a block of documents at once.  A block
is a run of rows of at most ``BLOCK_BYTES`` bytes (or one longer document), so
the memory a task needs is bounded by its longest document and not by its
partition.  Null texts count as empty.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACE = _byte_set((0x20, 0x20), (0x09, 0x0D))
#: Everything that is neither an ASCII letter or digit nor part of a non-ASCII character.
NON_WORD = _byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=_U)
        self.down = np.ones(1, dtype=_U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), BLOCK_BYTES + 64)
            for name, base in (("up", _BASE), ("down", _INV)):
                x = np.full(size, base, dtype=_U)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up, self.down


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(29))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


@dataclass
class Block:
    """Consecutive rows: their bytes, and row boundaries in them."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def column_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; nulls become empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_utf8()
    if column.null_count:
        column = column.fill_null(b"" if kind == pa.large_binary() else "")
    column = column.cast(kind)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


#: Caches that an operator keeps in a worker process from task to task.
KEPT: list[dict] = []


def blocks(column: pa.Array, limit: int | None = None) -> Iterator[Block]:
    """Cut a text column into blocks of whole rows.

    Worker processes serve one operator after the other; what another one has kept
    in this process goes first, so that memory does not add up over a pipeline.
    """
    if any(KEPT):
        for cache in KEPT:
            cache.clear()
        gc.collect()
    limit = limit or BLOCK_BYTES
    data, offsets = column_buffers(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield Block(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of a block in order: byte bounds, row in the block, 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each row: its first word, and the number of words at the end
    hasher: RangeHasher  # of the block's bytes, lower-cased if that was asked for

    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


class RangeHasher:
    """64-bit hashes of byte ranges ``[start, end)``; equal bytes hash alike."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        up, self._down = _POWERS.get(n + 1)
        self._total = np.zeros(n + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * up[:n], out=self._total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = self._total
        return mix((total[end] - total[start]) * self._down[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return RangeHasher(data)(start, end)


def words(block: Block, separators: np.ndarray = SPACE, lower: bool = True) -> Words:
    """All maximal runs of bytes that are no separators, within rows."""
    data = LOWER[block.data] if lower else block.data
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(separators[data], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = block.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] |= inside[1:-1][cuts]
    ends[cuts - 1] |= inside[1:-1][cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, block.offsets)
    row = np.repeat(np.arange(block.rows), np.diff(first))
    hasher = RangeHasher(data)
    return Words(start, end, row, hasher(start, end), first, hasher)


def gram_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive entries (rows are not looked at)."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=_U)
    g = np.zeros(m, dtype=_U)
    for i in range(k):
        g = g * _U(0xA24BAED4963EE407) + hashes[i : i + m]
    return mix(g + _U(k))


def row_grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every k-gram that lies in one row, in order."""
    g = gram_hash(w.hash, k)
    if not len(g):
        return np.zeros(0, np.int64), g
    ok = w.row[: len(g)] == w.row[k - 1 :]
    return w.row[: len(g)][ok], g[ok]


def shingles(w: Words, rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle) pairs sorted by row, and row boundaries in them.

    A row with 1 to k-1 words has its whole sequence as its only shingle.
    """
    at, g = row_grams(w, k)
    counts = w.per_row()
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.empty(len(short), dtype=_U)
        for i, r in enumerate(short):
            a, b = w.first[r], w.first[r + 1]
            extra[i] = gram_hash(w.hash[a:b], int(b - a))[0]
        at, g = np.concatenate([at, short]), np.concatenate([g, extra])
    order = np.lexsort((g, at))
    at, g = at[order], g[order]
    if len(g):
        keep = np.ones(len(g), dtype=bool)
        keep[1:] = (g[1:] != g[:-1]) | (at[1:] != at[:-1])
        at, g = at[keep], g[keep]
    return g, np.searchsorted(at, np.arange(rows + 1))
