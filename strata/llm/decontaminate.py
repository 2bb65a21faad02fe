"""Benchmark decontamination: suffix arrays of the training text, searched for every test suffix.

A document and a benchmark item are sequences of words (text lower-cased in A-Z,
words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``). A window is ``window`` consecutive
item words; an item with fewer words, but not none, is one window.

Method. Every block of documents (a shard of a task) gets a suffix array over its
words: suffixes sorted by the names of their next ``window`` words. Each test
suffix is binary-searched in it, all of them at once; the range found holds every
place of the window, and neighbouring finds of one item chain into the longest
verbatim matches. Only suffixes that start with the first ``lead`` words of some
test suffix are sorted: no other can match one.

Scale. The benchmark is a query set: it is read in blocks of at most
``block_words`` words (proven by counting while reading), each broadcast and held
against all documents in one pass without a shuffle. Results of several blocks
meet per document, by row key.

Defined cases: a null or wordless document has n_words 0 and no hit; null or
wordless items have no window; items that repeat an id count once; an item with a
null id hits words but is not counted or listed; rows of one document repeated
exactly get one result each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.tables import fresh_names, row_key

WINDOW = 10
LEAD = 3
BLOCK_WORDS = 200_000

_FOUND = ("rid long, n_words long, hits array<struct<lo:long,hi:long>>, items array<string>, "
          "matches array<struct<item_id:string,item_from:long,word_from:long,n_words:long>>")
_LISTS = ("hits", "items", "matches")


def word_names(block: tb.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of a block's words, the row of each, and each row's first word."""
    data = tb.LOWER[block.data]
    lo, hi = tb.runs(~tb.NOT_ALNUM[data], block.starts)
    names = tb.Names(data, 0).of(lo, hi) | tb.U64(1)  # 0 stands for the end of a text
    return names, tb.row_of(lo, block.starts), np.searchsorted(lo, block.starts)


class Probe:
    """The test suffixes of a block of items: distinct windows sorted, and the items of each."""

    def __init__(self, ids: list[str | None], texts: list[str], window: int, lead: int):
        self.window = window
        self.ids = ids
        rows, size, item, start = [], [], [], []
        for block in tb.blocks(pa.array(texts, pa.string()), 1 << 30):
            names, _, first = word_names(block)
            for i in range(block.n):
                words = names[first[i]:first[i + 1]]
                k = min(window, len(words))
                for s in range(len(words) - k + 1 if k else 0):
                    row = np.zeros(window, tb.U64)
                    row[:k] = words[s:s + k]
                    rows.append(row)
                    size.append(k)
                    item.append(block.lo + i)
                    start.append(s)
        grid = np.array(rows, tb.U64).reshape(-1, window)
        self.rows, back = np.unique(grid, axis=0, return_inverse=True) if len(grid) else (grid, np.zeros(0, int))
        back = back.reshape(-1)
        self.size = np.zeros(len(self.rows), np.int64)
        self.size[back] = size
        order = np.argsort(back, kind="stable")
        self.places = np.searchsorted(back[order], np.arange(len(self.rows) + 1))
        self.item, self.start = np.array(item, np.int64)[order], np.array(start, np.int64)[order]
        self.leads = {int(g): np.unique(self._lead(self.rows[np.minimum(self.size, lead) == g].T[:g]))
                      for g in np.unique(np.minimum(self.size, lead))}

    @staticmethod
    def _lead(columns) -> np.ndarray:
        h = np.zeros_like(columns[0])
        for c in columns:
            h = tb.mix(h * tb.U64(0x9E3779B97F4A7C15) + c)
        return h

    def candidates(self, names: np.ndarray) -> np.ndarray:
        """Word positions whose next words begin some window (positions near a text's end may not)."""
        keep = np.zeros(len(names), bool)
        for g, wanted in self.leads.items():
            if len(names) < g:
                continue
            h = self._lead([names[j:len(names) - g + 1 + j] for j in range(g)])
            slots = np.zeros(1 << 16, bool)
            slots[wanted & tb.U64(0xFFFF)] = True
            maybe = np.flatnonzero(slots[h & tb.U64(0xFFFF)])
            at = np.minimum(np.searchsorted(wanted, h[maybe]), len(wanted) - 1)
            keep[maybe[wanted[at] == h[maybe]]] = True
        return np.flatnonzero(keep)

    def search(self, names: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every (window, word position) at which a window stands; ``ends``: end of each word's text."""
        at = self.candidates(names)
        none = np.zeros(0, np.int64)
        if not len(at) or not len(self.rows):
            return none, none
        padded = np.concatenate((names, np.zeros(self.window, tb.U64)))
        places = at[:, None] + np.arange(self.window)
        suffix = np.where(places < ends[at][:, None], padded[places], tb.U64(0))
        order = np.lexsort(suffix.T[::-1])
        suffix, at = suffix[order], at[order]  # the suffix array
        valid = np.arange(self.window) < self.size[:, None]

        def bound(upper: bool) -> np.ndarray:
            lo, hi = np.zeros(len(self.rows), np.int64), np.full(len(self.rows), len(at), np.int64)
            while True:
                go = np.flatnonzero(lo < hi)
                if not len(go):
                    return lo
                mid = (lo[go] + hi[go]) >> 1
                there, own = suffix[mid], self.rows[go]
                differs = (there != own) & valid[go]
                c = differs.argmax(1)
                r = np.arange(len(go))
                less = np.where(differs[r, c], there[r, c] < own[r, c], upper)
                lo[go[less]] = mid[less] + 1
                hi[go[~less]] = mid[~less]

        low, high = bound(False), bound(True)
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, at[low[which] + inner]


def _chains(item, start, at, size) -> Iterator[tuple[int, int, int, int]]:
    """Longest matches from finds of single windows: (item, item_from, word_from, n_words)."""
    order = np.lexsort((at, at - start, item))
    item, start, at, size = item[order], start[order], at[order], size[order]
    new = np.ones(len(order), bool)
    new[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (start[1:] != start[:-1] + 1)
    f = np.flatnonzero(new)
    end = np.append(f[1:], len(order)) - 1
    yield from zip(item[f], start[f], at[f], at[end] + size[end] - at[f])


def _scan(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = shared.value
        for batch in batches:
            rids = batch.column(0)
            for block in tb.blocks(batch.column(1)):
                names, row, first = word_names(block)
                which, at = probe.search(names, first[row + 1]) if len(names) else (np.zeros(0, np.int64),) * 2
                hits = [[] for _ in range(block.n)]
                items: list[list] = [[] for _ in range(block.n)]
                matches: list[list] = [[] for _ in range(block.n)]
                if len(at):
                    in_row = row[at]
                    order = np.argsort(in_row, kind="stable")
                    cuts = np.flatnonzero(np.diff(in_row[order])) + 1
                    for part in np.split(order, cuts):
                        i = int(in_row[part[0]])
                        w, p = which[part], at[part] - first[i]
                        n = probe.places[w + 1] - probe.places[w]
                        each = np.repeat(np.arange(len(w)), n)
                        place = probe.places[w][each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                        found = probe.item[place]
                        for k, s, a, size in _chains(found, probe.start[place], p[each], probe.size[w][each]):
                            matches[i].append({"item_id": probe.ids[k], "item_from": int(s), "word_from": int(a),
                                               "n_words": int(size)})
                        items[i] = sorted({probe.ids[k] for k in np.unique(found) if probe.ids[k] is not None})
                        hits[i] = merged((int(a), int(a + s)) for a, s in zip(p, probe.size[w]))
                yield pa.RecordBatch.from_arrays([
                    rids.slice(block.lo, block.n), pa.array(np.diff(first), pa.int64()),
                    pa.array([[{"lo": a, "hi": b} for a, b in h] for h in hits],
                             pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(matches, pa.list_(pa.struct([("item_id", pa.string()), ("item_from", pa.int64()),
                                                          ("word_from", pa.int64()), ("n_words", pa.int64())]))),
                    batch.column(2).slice(block.lo, block.n)],
                    names=["rid", "n_words", "hits", "items", "matches", "doc_id"])
    return task


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _probes(benchmark: DataFrame, window: int, lead: int, block_words: int) -> Iterator[Probe]:
    """The benchmark in blocks of at most ``block_words`` words (or one item)."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).toLocalIterator():
        n = len(row.t or "") // 2 + 1  # a word and its separator take two characters at least
        if texts and size + n > block_words:
            yield Probe(ids, texts, window, lead)
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t or "")
        size += n
    yield Probe(ids, texts, window, lead)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, lead: int = LEAD,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row: rid, doc_id, n_words, n_hit, items, matches.

    ``items``: ids (as strings, sorted) of items with an occurring window;
    ``matches``: longest verbatim matches, by item and place, in words from 0.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(row_key().alias("rid"), "text", "doc_id")
    passes = [keyed.mapInArrow(_scan(spark.sparkContext.broadcast(probe)), f"{_FOUND}, doc_id {kind}")
              for probe in _probes(benchmark, window, lead, block_words)]
    found = passes[0]
    for other in passes[1:]:  # the same rows held against the next block of the benchmark
        more = (other.filter(F.size("hits") > 0).dropDuplicates(["rid"])
                .select("rid", *(F.col(c).alias(f"more_{c}") for c in _LISTS)))
        found = (found.join(more, "rid", "left")
                 .select("rid", "n_words", "doc_id",
                         *(F.when(F.col(f"more_{c}").isNull(), F.col(c)).otherwise(F.concat(c, f"more_{c}")).alias(c)
                           for c in _LISTS)))
    return found.select("rid", "doc_id", "n_words", _covered("hits").alias("n_hit"),
                        F.array_sort(F.array_distinct("items")).alias("items"), "matches")


def _covered(spans: str):
    """Words in the union of spans."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), start, lambda a, h: F.struct(
        F.greatest(a["end"], h["hi"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), h["hi"] - F.greatest(a["end"], h["lo"]))).alias("n")), lambda a: a["n"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents no window of the benchmark stands in, all columns kept."""
    key, = fresh_names(docs, "row_key")
    hit = find_matches(docs, benchmark, **options).filter("n_hit > 0").select(F.col("rid").alias(key)).distinct()
    return docs.withColumn(key, row_key()).join(hit, key, "left_anti").select(*docs.columns)
