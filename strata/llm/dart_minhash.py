"""MinHash near-dedup: DartMinHash signatures, banded joining, exact check, classes.

Documents are sets of word shingles (``words`` words, five by default; a text of
fewer words is one shingle); words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of
the text lower-cased in A-Z. Two documents are linked at a Jaccard similarity of
``threshold`` or more, and a class is a connected group of links.

Signature (DartMinHash). Each element owns an area, its weight by all ranks. The
area is cut into regions that double in weight and in rank; hashing (element,
region) tells how many darts fall there (Poisson, one per unit of area) and where.
The darts under the element's weight and below a rank that leaves about
k ln k + 2k of them over the whole document are kept, each hashed to one of k
coordinates; a coordinate's value is its earliest dart. A document with an empty
coordinate looks at ranks twice as high. The cost is that of the elements plus the
darts, not elements by coordinates. ``weighting="set"`` gives every distinct
shingle weight 1, so coordinates agree with the plain Jaccard similarity;
``"count"`` weighs a shingle by its occurrences.

Joining. Documents with equal shingle sets are one node. ``bands`` of
``k / bands`` coordinates are bucket keys. In each round the nodes of a bucket are
paired with one centre, never with all others: the node that meets most rows of
other classes over all its buckets (of a text and its many copies, the text; of a
large class and a few strangers, a stranger). Pairs are checked exactly on their
texts, and links join classes. A centre has then met its bucket and leaves it; only
buckets whose other nodes are of several classes stay in. Rounds end when one links
nothing more, or leaves more than ``ROUND_LEAVES`` of the classes open: their number
grows at most with the logarithm of the classes, whatever the buckets hold, and each
reads an entry of an open bucket a fixed number of times. At similarity 0.8 two documents share none of 32 bands of 4 with
probability 5e-8.

The rest. All nodes still in a bucket then go through an exact join of sets that
pairs no bucket with itself. The shingles that several of these nodes hold are
ordered by how many do, those of one node alone come before all. Two sets at the
threshold share a shingle near the front of both (prefix filter: a longer front for
the greater set than for the smaller), at places that leave room for the common
part (positional filter), and their sizes are close (length filter). Members of a
shingle's largest class are only paired with those of other classes. Of these pairs
only those go on to the exact check whose fronts share enough shingles.

Scale. One pass of Python over the texts; rows that shuffle are band keys (16
bytes), and texts only of nodes that have a candidate. Grouped minima combine
before their shuffle, and joins on centres are split by AQE, so a bucket that
holds a third of all rows costs its rows. Classes come from star steps written to
the shared folder.

Defined cases: a text that is null or has no words is in no link and its own
class; rows with equal sets (exact repetitions too) share a class; class_id is the
smallest id of the class (null ids are left out; null if all are); other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.components import components
from strata.llm.decontaminate import word_names
from strata.llm.suffix_dedup import _packed, _unpack
from strata.llm.tables import fresh_names, row_key, stage

WORDS = 5
THRESHOLD = 0.8
COORDINATES = 128
BANDS = 32

#: rounds of centres go on while one leaves at most this share of the classes in open buckets
ROUND_LEAVES = 0.75

#: rows that throw darts at a time, and pairs and bytes of text that are compared at a time
DART_ROWS = 1024
PAIRS, PAIR_BYTES = 256, 2 << 20

_STEP = tb.U64(0x9E3779B97F4A7C15)
_FINEST = 6       # the first rank strip is [0, 2 ** -6)
_RANK_BITS = 42   # ranks below 2 ** 13 in fixed point; rows by coordinates take the rest of a word


def shingles(block: tb.Block, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a block: row, name and count, sorted by row and name."""
    names, row, first = word_names(block)
    if not len(names):
        z = np.zeros(0, np.int64)
        return z, z.view(tb.U64), z
    n = np.diff(first)
    h = np.zeros(len(names), tb.U64)
    for j in range(words):
        h = tb.mix(h * _STEP + np.append(names[j:], np.zeros(min(j, len(names)), tb.U64)))
    whole = np.flatnonzero((n > 0) & (n < words))
    at = np.arange(len(names))
    keep = at <= first[row + 1] - words
    if len(whole):  # a short text is one shingle, its length told apart
        v = n[whole].astype(tb.U64)
        for j in range(words - 1):
            go = n[whole] > j
            v[go] = tb.mix(v[go] * _STEP + names[first[whole[go]] + j])
        h[first[whole]] = v
        keep[first[whole]] = True
    h, row = h[keep], row[keep]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    f = np.flatnonzero(new)
    return row[f], h[f], np.diff(np.append(f, len(h)))


def _poisson(u: np.ndarray, area: float) -> np.ndarray:
    """Poisson counts of mean ``area`` from uniform words, by inversion."""
    p = c = np.exp(-area)
    n = np.zeros(len(u), np.int64)
    for k in range(1, 24):
        over = u >= tb.U64(min(int(c * 2.0 ** 64), (1 << 64) - 1))
        if not over.any():
            break
        n += over
        p = p * area / k
        c += p
    return n


def _darts(name, weight, row, limit):
    """Darts of the elements below their row's rank limit: (row, coordinate hash, rank)."""
    out = []
    top = float(limit.max())
    most = float(weight.max())
    w_lo, w_len, i = 0.0, 1.0, 0
    while w_lo < most:
        heavy = np.flatnonzero(weight > w_lo) if i else np.arange(len(name))
        r_lo, r_len, j = 0.0, 2.0 ** -_FINEST, 0
        while r_lo < top:
            sel = heavy[limit[row[heavy]] > r_lo]
            cells = max(1, int(w_len * r_len))
            region = np.array([(i << 40) + (j << 32) + 1], np.uint64) * _STEP
            h = tb.mix(name[sel] + region)
            if cells > 1:
                cell = np.tile(np.arange(cells, dtype=tb.U64), len(sel))
                sel = np.repeat(sel, cells)
                h = tb.mix(np.repeat(h, cells) + _STEP * cell)
            else:
                cell = None
            count = _poisson(h, w_len * r_len / cells)
            hit = np.flatnonzero(count)
            n = count[hit]
            each = np.repeat(hit, n)
            number = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            dart = tb.mix(h[each] ^ tb.mix((number + 1).astype(tb.U64) * _STEP))
            rank = (dart >> tb.U64(11)).astype(np.float64) * 2.0 ** -53
            if cell is not None:
                rank = (rank + cell[each].astype(np.float64)) / cells
            rank = r_lo + r_len * rank
            src = sel[each]
            keep = rank < limit[row[src]]
            side = tb.mix(dart + _STEP)
            if most > 1 or w_len > 1:
                keep &= w_lo + w_len * ((side >> tb.U64(11)).astype(np.float64) * 2.0 ** -53) < weight[src]
            out.append((row[src[keep]], tb.mix(side[keep] + _STEP), rank[keep]))
            r_lo += r_len
            r_len = r_len if j == 0 else 2 * r_len
            j += 1
        w_lo += w_len
        w_len = w_len if i == 0 else 2 * w_len
        i += 1
    return [np.concatenate(x) for x in zip(*out)]


def signatures(row, name, weight, rows: int, k: int = COORDINATES) -> np.ndarray:
    """A (rows, k) array: per row and coordinate the earliest dart (0 for rows without elements).

    ``row`` ascends. Every row throws about k ln k + 2k darts, however short it is, so
    ``DART_ROWS`` rows throw at a time.
    """
    if rows <= DART_ROWS:
        return _signatures(row, name, weight, rows, k)
    cuts = np.searchsorted(row, np.arange(0, rows + DART_ROWS, DART_ROWS))
    return np.concatenate([
        _signatures(row[a:b] - lo, name[a:b], weight[a:b], min(DART_ROWS, rows - lo), k)
        for lo, a, b in zip(range(0, rows, DART_ROWS), cuts[:-1], cuts[1:])])


def _signatures(row, name, weight, rows: int, k: int) -> np.ndarray:
    sig = np.zeros((rows, k), np.uint64)
    if not len(row):
        return sig
    weight = weight.astype(np.float64)
    total = np.bincount(row, weight, rows)
    limit = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    bits = tb.U64(_RANK_BITS)
    while todo.any():
        own = todo[row]
        r, h, rank = _darts(name[own], weight[own], row[own], limit)
        slot = r.astype(tb.U64) * tb.U64(k) + h % tb.U64(k)
        packed = np.sort((slot << bits) | (rank * 2.0 ** (_RANK_BITS - 13)).astype(tb.U64))
        at = packed >> bits
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1]
        f = np.flatnonzero(first)
        filled = np.bincount((at[f] // tb.U64(k)).astype(np.int64), minlength=rows)
        flat = sig.reshape(-1)
        flat[at[f].astype(np.int64)] = tb.mix(packed[f] & ((tb.U64(1) << bits) - tb.U64(1))) | tb.U64(1)
        todo &= filled < k
        limit = np.where(todo, 2 * limit, limit)
    return sig


def _signed(words: int, k: int, bands: int, counted: bool):
    """(rid, doc, text) to (rid, doc, node, band keys)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch.column("text")):
                row, name, count = shingles(block, words)
                weight = count if counted else np.ones(len(count))
                sig = signatures(row, name, weight, block.n, k)
                element = tb.mix(name ^ tb.mix(count.astype(tb.U64))) if counted else tb.mix(name)
                ends = np.searchsorted(row, np.arange(block.n + 1))
                sums = np.concatenate((np.zeros(1, tb.U64), np.cumsum(element)))
                node = tb.mix(sums[ends[1:]] - sums[ends[:-1]] + np.diff(ends).astype(tb.U64))
                none = ends[1:] == ends[:-1]
                key = np.zeros((block.n, bands), tb.U64)
                for j in range(k // bands):
                    key = tb.mix(key * _STEP + sig[:, j::k // bands][:, :bands] + np.arange(bands, dtype=tb.U64))
                flat = pa.array(key.reshape(-1).view(np.int64))
                offsets = np.concatenate(([0], np.cumsum(np.where(none, 0, bands))))
                if none.any():
                    flat = pa.array(key[~none].reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    batch.column("rid").slice(block.lo, block.n), batch.column("doc").slice(block.lo, block.n),
                    pa.array(node.view(np.int64), mask=none),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)], ["rid", "doc", "node", "bands"])
    return task


def similarities(a: pa.Array, b: pa.Array, words: int, counted: bool) -> np.ndarray:
    """Exact Jaccard similarity of the texts in two columns, row by row."""
    sides = []
    for column in (a, b):
        rows, names, counts = [], [], []
        for block in tb.blocks(column):
            r, h, c = shingles(block, words)
            rows.append(r + block.lo)
            names.append(h)
            counts.append(c if counted else np.ones(len(c), np.int64))
        sides.append([np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, names, counts)])
    n = len(a)
    size = sum(np.bincount(r.astype(np.int64), c, n) for r, _, c in sides)
    row, name, count = (np.concatenate(x) for x in zip(*sides))
    order = np.lexsort((name, row))
    row, name, count = row[order], name[order], count[order]
    both = np.flatnonzero((row[1:] == row[:-1]) & (name[1:] == name[:-1]))
    common = np.bincount(row[both].astype(np.int64), np.minimum(count[both], count[both + 1]), n)
    return common / np.maximum(size - common, 1)


def _checked(words: int, threshold: float, counted: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [c for c in batch.schema.names if c not in ("za", "zb")]
            for lo, texts in _pairs_of_texts(batch):
                s = similarities(*texts, words, counted)
                ok = pa.array(s >= threshold - 1e-12)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, len(s)).filter(ok) for c in rest], rest)
    return task


def _pairs_of_texts(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple[pa.Array, pa.Array]]]:
    """The texts of a batch's pairs and the first one's place, at most PAIRS and about PAIR_BYTES at a time."""
    a, b, size, lo = [], [], 0, 0
    for i in range(batch.num_rows):
        x, y = (_unpack(batch.column(c)[i].as_py()) for c in ("za", "zb"))
        if a and (len(a) == PAIRS or size + len(x) + len(y) > PAIR_BYTES):
            yield lo, (pa.array(a, pa.large_binary()), pa.array(b, pa.large_binary()))
            a, b, size, lo = [], [], 0, i
        a.append(x)
        b.append(y)
        size += len(x) + len(y)
    if a:
        yield lo, (pa.array(a, pa.large_binary()), pa.array(b, pa.large_binary()))


def _tokens(words: int, counted: bool):
    """(node, z) to (node, size, token): a token for each shingle, or each occurrence when counted."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for at in range(0, batch.num_rows, 64):
                part = batch.column("z").slice(at, 64)
                texts = pa.array([_unpack(z.as_py()) for z in part], pa.binary())
                for block in tb.blocks(texts):
                    row, name, count = shingles(block, words)
                    if counted:
                        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                        row, name = np.repeat(row, count), np.repeat(name, count)
                        name = tb.mix(name + _STEP * nth.astype(tb.U64))
                    size = np.bincount(row, minlength=block.n)
                    own = nodes[at + block.lo:at + block.lo + block.n]
                    for lo in range(0, len(row), 1 << 18):
                        r = row[lo:lo + (1 << 18)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[r]), pa.array(size[r]), pa.array(name[lo:lo + (1 << 18)].view(np.int64))],
                            ["node", "size", "token"])
    return task


def _close_pairs(texts: DataFrame, label: DataFrame, words: int, threshold: float, counted: bool) -> DataFrame:
    """Pairs (a, b) of nodes of two classes, labels (p, q), that pass the filters of the exact join.

    No pair at the threshold is left out, whatever its shingles: the order only decides how many others pass.
    """
    tokens = texts.select("node", "z").mapInArrow(_tokens(words, counted), "node long, size long, token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    ordered = (tokens.join(often, "token").groupBy("node", "size")
               .agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("t")))
    # tokens of this node alone come first and meet nobody
    front = F.col("size") - F.ceil(threshold * F.col("size") - 1e-6) + 1
    entries = stage(ordered.withColumn("alone", F.col("size") - F.size("t")).withColumn("front", front)
                    .filter("front > alone")
                    .select("node", "size", "alone", F.posexplode(F.expr("slice(t, 1, int(front - alone))")).alias("i", "t"))
                    .select("node", "size", F.col("t.token").alias("token"), (F.col("alone") + F.col("i")).alias("pos"))
                    .join(label, "node"), "entries")
    own = entries.groupBy("token", "label").agg(F.count("*").alias("m"))
    top = (own.groupBy("token").agg(F.max(F.struct("m", "label")).alias("top"), F.count("*").alias("classes"))
           .filter("classes > 1").select("token", F.col("top.label").alias("top")))
    placed = stage(entries.join(top, "token").withColumn("most", F.col("label") == F.col("top")).drop("top"), "fronts")
    part = threshold / (1 + threshold)
    small = (placed.filter(F.col("pos") <= F.col("size") - F.ceil(2 * part * F.col("size") - 1e-6))
             .select("token", F.col("most").alias("side"), *(F.col(c).alias(f"{c}_s") for c in ("node", "size", "pos", "label"))))
    sides = F.when(F.col("most"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    large = placed.select("token", F.explode(sides).alias("side"), "node", "size", "pos", "label")
    room = F.least(F.col("size_s") - F.col("pos_s"), F.col("size") - F.col("pos"))
    pairs = (small.join(large, ["token", "side"])
            .filter((F.col("label_s") != F.col("label"))
                    & (F.struct("size_s", "node_s") < F.struct(F.col("size").alias("size_s"), F.col("node").alias("node_s")))
                    & (F.col("size_s") >= threshold * F.col("size") - 1e-6)
                    & (room >= part * (F.col("size_s") + F.col("size")) - 1e-6))
            .groupBy(F.least("node", "node_s").alias("a"), F.greatest("node", "node_s").alias("b"))
            .agg(F.min(F.least("label", "label_s")).alias("p"), F.max(F.greatest("label", "label_s")).alias("q")))
    return _sharing_enough(pairs, entries, threshold)


def _sharing_enough(pairs: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose fronts share enough shingles for the threshold.

    Of the two fronts take the one that ends first in the order. What two sets share up to its end lies in both fronts;
    behind it the set has ``ceil(threshold * size) - 1`` shingles. So what the fronts share and the greater of these
    two rests must reach the common part that the threshold asks for.
    """
    fronts = stage(entries.groupBy("node", "size").agg(F.collect_list("token").alias("front")), "front-tokens")
    both = pairs
    for side in ("a", "b"):
        both = both.join(fronts.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("front").alias(f"front_{side}")), side)
    rest = F.greatest(*(F.ceil(threshold * F.col(f"size_{s}") - 1e-6) for s in ("a", "b"))) - 1
    wanted = threshold / (1 + threshold) * (F.col("size_a") + F.col("size_b"))
    return (both.filter(F.size(F.array_intersect("front_a", "front_b")) + rest >= wanted - 1e-6)
            .select("a", "b", "p", "q"))


def _with_centres(open_: DataFrame) -> DataFrame:
    """Entries (key, node, label) of buckets of several classes with their bucket's centre: c and c_label.

    A node's weight: the rows of other classes it meets, over all its buckets.
    """
    own = open_.groupBy("key", "label").agg(F.count("*").alias("m"))
    whole = own.groupBy("key").agg(F.sum("m").alias("n"))
    meets = (open_.join(own, ["key", "label"]).join(whole, "key")
             .groupBy("node").agg(F.sum(F.col("n") - F.col("m")).alias("weight")))
    weighed = open_.join(meets, "node")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", "node", "label")).alias("c"))
    return (open_.join(centre, "key")
            .select("key", "node", "label", F.col("c.node").alias("c"), F.col("c.label").alias("c_label")))


def near_duplicate_classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                           k: int = COORDINATES, bands: int = BANDS, weighting: str = "set") -> DataFrame:
    """One row per document row: rid, doc_id, class_id (smallest id of its class) and class_key.

    ``class_key`` is the same for exactly the rows of one class; null where the text has no words.
    """
    if k % bands or not 0 < threshold <= 1 or weighting not in ("set", "count"):
        raise ValueError("bands must divide k, 0 < threshold <= 1, weighting is set or count")
    counted = weighting == "count"
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(row_key().alias("rid"), F.col("doc_id").alias("doc"), "text")
    signed = stage(keyed.mapInArrow(_signed(words, k, bands, counted),
                                    f"rid long, doc {kind}, node long, bands array<long>"), "signed")
    entries = signed.select("node", F.explode("bands").alias("key"))
    shared = (entries.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .filter("least <> most").select("key"))
    members = stage(entries.join(shared, "key").select("key", "node", F.col("node").alias("label")).distinct(), "members")
    label = members.select("node", "label").distinct()
    # the text of one row of each node that has a candidate
    chosen = (signed.select("node", "rid").join(members.select("node").distinct(), "node")
              .groupBy("node").agg(F.min("rid").alias("rid")))
    texts = stage(docs.select(row_key().alias("rid"), "text").mapInArrow(_packed, "rid long, z binary")
                  .join(chosen, "rid").groupBy("node").agg(F.first("z").alias("z")), "texts")

    def check(pairs: DataFrame, *rest: str) -> DataFrame:
        with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("z").alias("za")), "a")
        with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("z").alias("zb")), "b")
        return with_b.select("a", "b", *rest, "za", "zb").mapInArrow(_checked(words, threshold, counted), ", ".join(f"{c} long" for c in ("a", "b", *rest)))

    def joined(label: DataFrame, links: DataFrame) -> DataFrame:
        roots = components(links.select(F.col("p").alias("a"), F.col("q").alias("b")))
        return stage(label.join(roots.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
                     .select("node", F.coalesce("root", "label").alias("label")), "labels")

    def classes(open_: DataFrame) -> int:
        return open_.agg(F.count_distinct("label")).first()[0]

    open_, n_open = members, classes(members)
    while n_open:
        met = stage(_with_centres(open_), "met")
        pairs = (met.filter("label <> c_label")
                 .groupBy(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b"))
                 .agg(F.min(F.least("label", "c_label")).alias("p"), F.max(F.greatest("label", "c_label")).alias("q")))
        more = stage(check(pairs, "p", "q"), "links")
        linked = not more.isEmpty()
        if linked:
            label = joined(label, more)
        # a centre has met its bucket
        placed = met.filter("node <> c").select("key", "node").join(label, "node")
        live = placed.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h")
        open_ = stage(placed.join(live.select("key"), "key").select("key", "node", "label"), "open")
        before, n_open = n_open, classes(open_)
        if not linked or n_open > ROUND_LEAVES * before:
            break
    if n_open:
        rest = stage(open_.select("node", "label").distinct(), "rest")
        more = stage(check(_close_pairs(texts.join(rest.select("node"), "node"), rest, words, threshold, counted),
                           "p", "q"), "links")
        if not more.isEmpty():
            label = joined(label, more)
    placed = (signed.select("rid", "doc", "node").join(label, "node", "left")
              .select("rid", "doc", F.coalesce("label", "node").alias("class_key")))
    least = placed.filter("class_key IS NOT NULL").groupBy("class_key").agg(F.min("doc").alias("class_id"))
    return (placed.join(least, "class_key", "left")
            .select("rid", F.col("doc").alias("doc_id"),
                    F.when(F.col("class_key").isNull(), F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
                    "class_key"))


def first_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """One document of each class (the one with the smallest id), all columns kept.

    Texts without words are in no class and all stay.
    """
    classes = near_duplicate_classes(docs, **options)
    key, every, n = fresh_names(docs, "row_key", "every", "n")
    best = (classes.filter("class_key IS NOT NULL")
            .groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("best"))
            .select(F.col("best.rid").alias(key)))
    wordless = classes.filter("class_key IS NULL").select(F.col("rid").alias(key)).distinct()
    keep = (best.withColumn(every, F.lit(False)).unionByName(wordless.withColumn(every, F.lit(True))))
    # one join for the texts; of rows that repeat exactly one stays, unless they have no words
    rows = (docs.withColumn(key, row_key()).join(keep, key)
            .withColumn(n, F.when(F.col(every), F.monotonically_increasing_id()).otherwise(F.lit(0))))
    return rows.dropDuplicates([key, n]).select(*docs.columns)
