"""Counts over whole texts that several operators share, vectorised over a block."""

from __future__ import annotations

import numpy as np

from strata.llm import textblocks as tb

SYMBOLS = tb.byte_class(b"#*$%&|<>")
_STEP = tb.U64(0x9E3779B97F4A7C15)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a block: byte ranges, names, rows, and each row's first."""

    def __init__(self, block: tb.Block):
        self.block = block
        self.inside = ~tb.SPACE[block.data]
        self.lo, self.hi = tb.runs(self.inside, block.starts)
        self.hash = tb.Names(block.data, 0)
        self.names = self.hash.of(self.lo, self.hi)
        self.row = tb.row_of(self.lo, block.starts)
        self.first = np.searchsorted(self.lo, block.starts)
        self.n = np.diff(self.first)


def keyed(row: np.ndarray, names: np.ndarray) -> np.ndarray:
    """One 64-bit name of (row, name)."""
    return tb.mix(names + _STEP * (row.astype(tb.U64) + tb.U64(1)))


def repeated(key: np.ndarray) -> np.ndarray:
    """Which keys stand twice or more. Slots filled once settle most of them without a sort."""
    slot = (key & tb.U64((1 << 22) - 1)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(slot, minlength=1 << 22)[slot] > 1)
    own = np.sort(key[maybe])
    twice = own[1:][own[1:] == own[:-1]]
    out = np.zeros(len(key), bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, key[maybe]), len(twice) - 1)
        out[maybe] = twice[at] == key[maybe]
    return out


def distinct_per_row(row: np.ndarray, names: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct names in each row."""
    key = keyed(row, names)
    order = np.argsort(key)
    own = key[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    return np.bincount(row[order[new]], minlength=rows)


def duplicate_lines(words: Words) -> np.ndarray:
    """Per row: lines (between \\n) with a word that equal an earlier line of the row."""
    block = words.block
    breaks = np.flatnonzero(block.data == 10)
    if not len(words.lo):
        return np.zeros(block.n, np.int64)
    lo = np.unique(np.concatenate((block.starts[:-1], breaks + 1)))
    lo = lo[lo < len(block.data)]
    hi = np.append(lo[1:], len(block.data))
    hi = hi - ((hi > lo) & (block.data[np.maximum(hi - 1, 0)] == 10))
    worded = np.searchsorted(words.lo, hi) > np.searchsorted(words.lo, lo)
    lo, hi = lo[worded], hi[worded]
    row = tb.row_of(lo, block.starts)
    again = np.flatnonzero(repeated(keyed(row, words.hash.of(lo, hi))))
    if not len(again):
        return np.zeros(block.n, np.int64)
    a, b, r = words.hash.of(lo[again], hi[again]), tb.Names(block.data, 1).of(lo[again], hi[again]), row[again]
    order = np.lexsort((b, a, r))
    later = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (r[order][1:] == r[order][:-1])
    return np.bincount(r[order][1:][later], minlength=block.n)


def repeated_window_words(words: Words, window: int = 3) -> np.ndarray:
    """Per row: words inside windows of ``window`` words that stand twice or more in the row."""
    n = len(words.names)
    if n < window:
        return np.zeros(words.block.n, np.int64)
    h = np.zeros(n - window + 1, tb.U64)
    for j in range(window):
        h = tb.mix(h * _STEP + words.names[j:n - window + 1 + j])
    at = np.flatnonzero(np.arange(n - window + 1) + window <= words.first[words.row[:n - window + 1] + 1])
    again = at[repeated(keyed(words.row[at], h[at]))]
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + window, -1)
    return tb.per_row(np.cumsum(covered[:-1]) > 0, words.first)
