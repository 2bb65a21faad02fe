"""Vectorised helpers over Arrow text columns: blocks of whole texts, words, rolling names.

Used inside ``mapInArrow`` tasks. A block holds whole rows (never a part of a
text), about ``BLOCK_BYTES`` of them, so memory stays bounded by the longest
text and not by the Arrow batch. Nothing here touches Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 8192

U64 = np.uint64


class Block:
    """Rows ``lo`` to ``hi`` of a batch: their UTF-8 bytes one after another, and where each starts."""

    __slots__ = ("lo", "hi", "data", "starts")

    def __init__(self, lo: int, hi: int, data: np.ndarray, starts: np.ndarray):
        self.lo, self.hi, self.data, self.starts = lo, hi, data, starts

    @property
    def n(self) -> int:
        return self.hi - self.lo

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i + 1]].tobytes()


def blocks(column: pa.Array, size: int | None = None) -> Iterator[Block]:
    """Cut a string or binary column into blocks of whole rows; a null is an empty text."""
    size = size or BLOCK_BYTES
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, min(lo + BLOCK_ROWS, int(np.searchsorted(off, off[lo] + size, "right")) - 1))
        yield Block(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


# --- names: 64-bit polynomial hashes of byte ranges --------------------------------

_BASES = (U64(0x9E3779B97F4A7C15 | 5), U64(0xD1342543DE82EF95 | 5))


def _inverse(b: int) -> int:
    x = b
    for _ in range(6):
        x = x * (2 - b * x) % (1 << 64)
    return x


_TABLES = [np.random.default_rng(1000 + lane).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
           for lane in (0, 1)]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(lane)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = []
        for b in (int(_BASES[lane]), _inverse(int(_BASES[lane]))):
            p = np.full(size, b, U64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = (made[0], made[1])
        if size <= BLOCK_BYTES + 1:      # those of a longer text are not kept
            _POWERS[lane] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise: spreads every bit of a polynomial value over the word."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class Names:
    """Prefix sums of one hash lane over ``data``; names any byte range in constant time."""

    def __init__(self, data: np.ndarray, lane: int = 0):
        up, self.down = _powers(lane, len(data) + 1)
        t = _TABLES[lane][data]
        t *= up[:len(data)]
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(t, out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo] + (hi - lo).astype(U64))

    def grams(self, m: int) -> np.ndarray:
        """Names of all ``m``-byte strings, by start."""
        n = len(self.sums) - 1
        if n < m:
            return np.zeros(0, U64)
        return mix((self.sums[m:] - self.sums[:n - m + 1]) * self.down[:n - m + 1] + U64(m))


def release() -> None:
    """Give freed memory back to the system: a Python worker goes on to other tasks."""
    import ctypes
    import gc
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):    # another C library
        pass


# --- words -------------------------------------------------------------------------

def byte_class(members) -> np.ndarray:
    """A 256-entry membership table of byte values."""
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


#: `[^\x20\x09-\x0D]+`
SPACE = byte_class([0x20, *range(0x09, 0x0E)])
#: the separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, on text whose A-Z are lower-cased
NOT_ALNUM = byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True bytes; a run never crosses a row's start."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = starts[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def row_of(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The row in which each byte position lies (positions inside non-empty rows)."""
    return np.searchsorted(starts, at, "right") - 1


def per_row(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one per byte or item) over each row given by ``starts``."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[starts[1:]] - sums[starts[:-1]]
