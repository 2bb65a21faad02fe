"""Suffix-array dedup: repeated strings of ``threshold`` bytes, by prefix doubling on sampled suffixes.

``repeated_spans`` finds, for every document, the bytes covered by a string of
``threshold`` bytes that also starts earlier (smaller id; in the same document,
an earlier start). Strings never cross documents; a text is its UTF-8 bytes.

Method. Prefix doubling ranks every suffix by its first h bytes, sorts the pairs
(rank, rank at offset h), and drops suffixes whose rank has become unique. A pair
per byte is 30 to 40 bytes of shuffle for each byte of text and round, so the
suffixes are sampled first: of the ``gram``-byte strings inside each
``threshold``-byte window only the one with the smallest hash is a suffix to rank
(two equal windows pick the same one at the same offset), one in about 35. Then

1. offset 0: (rank of ``gram`` bytes, rank of the whole run of windows that picked
   the suffix, position) pairs are sorted by Spark. A suffix whose first rank is
   unique drops out, and all its windows with it. Of equal runs the first stays
   and the others are repeats as a whole.
2. past the threshold: runs whose first rank is shared but whose extensions
   differ are reranked window by window at full length; the first of each rank
   stays.

Ranks are names: equal strings get equal 64-bit hashes (128 bits, two lanes,
decide equality), so a rank needs no global counter.

Scale. One shuffle of the sampled pairs, one of the runs left open (text joined
once for their bytes), one join that brings the spans to their texts. Pairs that
repeat within a block of texts are settled before the shuffle, so a hot string
contributes one pair a block. A hot first rank is read as a sorted stream, cut
every ``group_rows`` runs into groups of their own; windows of such groups meet
again in a grouped minimum that combines before its shuffle.

Defined cases: a null text is empty (0 bytes, nothing removed); texts shorter
than ``threshold`` lose nothing; rows with one id are one document for the order
of positions, so exact repetitions of a row (id and text) all get the same result
and do not remove each other; a null id sorts before all ids; other columns pass
through untouched and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.tables import row_key, stage

THRESHOLD = 100
GRAM = 32
GROUP_ROWS = 20_000

_PAIRS = "key long, seg long, rid long, doc long, lo long, n int"
_RUNS = "rid long, doc long, lo long, n int, key long, part int"
_NULL_ID = -(1 << 63)
_BATCH = 1 << 16


def _table(schema: str, columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
        names=[n for n, _ in fields])


def _i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sample(block: tb.Block, threshold: int, gram: int):
    """Sampled suffixes of a block: rows, window runs [lo, lo + n), first rank, rank of the run."""
    data, starts = block.data, block.starts
    empty = np.zeros(0, np.int64)
    if len(data) < threshold:
        return empty, empty, empty, empty.view(tb.U64), empty.view(tb.U64)
    first, second = tb.Names(data, 0), tb.Names(data, 1)
    h = first.grams(gram)
    index = tb.U64((1 << len(data).bit_length()) - 1)
    least = (h & ~index) | np.arange(len(h), dtype=tb.U64)
    width, s = threshold - gram + 1, 1
    while 2 * s <= width:
        least = np.minimum(least[:-s], least[s:])
        s *= 2
    if s < width:
        least = np.minimum(least[:s - width], least[width - s:])
    # windows that stay inside their row
    inside = np.ones(len(least) + 1, bool)
    for lo, hi in zip(np.maximum(starts[1:] - threshold + 1, starts[:-1]), starts[1:]):
        inside[lo:hi] = False
    at = np.flatnonzero(inside[:len(least)])
    if not len(at):
        return empty, empty, empty, empty.view(tb.U64), empty.view(tb.U64)
    picked = (least[at] & index).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(picked) != 0) | (np.diff(at) != 1)
    f = np.flatnonzero(new)
    lo, n, pick = at[f], np.diff(np.append(f, len(at))), picked[f]
    run = second.of(lo, lo + n - 1 + threshold) ^ tb.mix((pick - lo).astype(tb.U64))
    return tb.row_of(lo, starts), lo, n, h[pick], run


def _chunks(column, threshold: int) -> Iterator[tuple[tb.Block, int]]:
    """Blocks of texts; a text of several blocks comes in pieces that share threshold - 1 bytes.

    A piece's windows are its own. Where a piece ends inside a run, the run is
    named in two parts, which are then ranked window by window.
    """
    for block in tb.blocks(column):
        if len(block.data) <= 2 * tb.BLOCK_BYTES:
            yield block, 0
            continue
        for at in range(0, len(block.data), tb.BLOCK_BYTES):
            piece = block.data[at:at + tb.BLOCK_BYTES + threshold - 1]
            yield tb.Block(block.lo, block.hi, piece, np.array([0, len(piece)])), at


def _pairs(threshold: int, gram: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for block, skipped in _chunks(batch.column(2), threshold):
                row, lo, n, key, run = _sample(block, threshold, gram)
                if not len(row):
                    continue
                doc, rid = ids[block.lo + row], rids[block.lo + row]
                at = lo - block.starts[row] + skipped
                # what repeats inside the block is settled here: only its first goes on as a pair
                order = np.lexsort((rid, at, doc, run, key))
                k, r = key[order], run[order]
                later = np.zeros(len(order), bool)
                later[1:] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
                d, a, i = doc[order], at[order], rid[order]
                lead = np.flatnonzero(~later)[np.cumsum(~later) - 1]
                same = later & (d == d[lead]) & (a == a[lead])
                again = np.zeros(len(order), bool)
                again[1:] = same[1:] & (i[1:] == i[:-1]) & (d[1:] == d[:-1]) & (a[1:] == a[:-1])
                go = order[(~later | same) & ~again]
                yield _table(_PAIRS, (_i64(key[go]), _i64(run[go]), rid[go], doc[go], at[go],
                                      n[go].astype(np.int32)))
                rest = np.sort(order[later & ~same])
                if len(rest):  # neighbouring runs of a row become one span
                    r0, a0, n0 = row[rest], at[rest], n[rest]
                    new = np.ones(len(rest), bool)
                    new[1:] = (r0[1:] != r0[:-1]) | (a0[1:] != a0[:-1] + n0[:-1])
                    f = np.flatnonzero(new)
                    size = np.add.reduceat(n0, f)
                    src = rid[rest][f]
                    yield _table(_PAIRS, (_i64(tb.mix(src.view(tb.U64) + size.astype(tb.U64))),
                                          np.zeros(len(f), np.int64), src, doc[rest][f], a0[f],
                                          (-size).astype(np.int32)))
    return task


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _rerank(group_rows: int):
    """Over pairs sorted by (key, seg, doc, lo): spans known to repeat, and runs still open.

    Reads the stream once; besides a batch it keeps the first run of the key at hand.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None    # (key, seg, doc, lo) of the pair before, and of the first with its key and seg
        waiting = None  # the first run of the key, while the key has no second one
        ordinal = 0
        before = None
        for batch in batches:
            key, seg, rid, doc, lo, n = _columns(batch)
            span = n < 0
            m = int(span.sum())
            if m:
                yield _table(_RUNS, (rid[span], doc[span], lo[span], -n[span], np.zeros(m, np.int64),
                                     np.full(m, -1, np.int32)))
                key, seg, rid, doc, lo, n = (c[~span] for c in (key, seg, rid, doc, lo, n))
            if not len(key):
                continue
            again = np.zeros(len(key), bool)  # the same row of the table, met in another block
            again[1:] = ((key[1:] == key[:-1]) & (seg[1:] == seg[:-1]) & (rid[1:] == rid[:-1])
                         & (doc[1:] == doc[:-1]) & (lo[1:] == lo[:-1]))
            again[0] = before == (key[0], seg[0], rid[0], doc[0], lo[0])
            before = (key[-1], seg[-1], rid[-1], doc[-1], lo[-1])
            if again.any():
                key, seg, rid, doc, lo, n = (c[~again] for c in (key, seg, rid, doc, lo, n))
                if not len(key):
                    continue
            carry = last is not None and last[0] == key[0]
            new_key = np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            new_key[0] = not carry
            new_seg = new_key.copy()
            new_seg[1:] |= seg[1:] != seg[:-1]
            new_seg[0] |= not (carry and last[1] == seg[0])
            # the first position of each seg: the pairs are sorted, ties at it are not later
            lead = np.where(new_seg, np.arange(len(key)), -1)
            lead = np.maximum.accumulate(lead)
            head_doc = np.where(lead >= 0, doc[lead], last[2] if last else 0)
            head_lo = np.where(lead >= 0, lo[lead], last[3] if last else 0)
            later = (doc != head_doc) | (lo != head_lo)
            repeat = np.flatnonzero(later)
            if len(repeat):
                yield _table(_RUNS, (rid[repeat], doc[repeat], lo[repeat], n[repeat],
                                     np.zeros(len(repeat), np.int64), np.full(len(repeat), -1, np.int32)))
            # runs: the first of each seg, and rows of the same position (one id, equal bytes)
            segs = np.cumsum(new_seg)
            base = np.zeros(len(key), np.int64)
            marks = np.flatnonzero(new_key)
            base[marks] = segs[marks] - 1
            base = np.maximum.accumulate(base)
            number = segs - base  # 1, 2, ... within the key
            first_key = np.cumsum(new_key) == 0  # still the key of the batch before
            number = number + np.where(first_key, ordinal, 0)
            ends = np.append(marks, len(key))
            if not new_key[0]:
                ends = np.append([0], ends)
            bounds = np.unique(ends)
            top = np.repeat(number[bounds[1:] - 1], np.diff(bounds))
            many = top > 1
            out = np.flatnonzero(~later & many)
            rows = [(rid[out], doc[out], lo[out], n[out], key[out], (number[out] - 1) // group_rows)]
            if waiting is not None and carry and many[0] and ordinal == 1:
                rows.insert(0, tuple(np.concatenate(x) for x in zip(*waiting)))
                waiting = None
            if sum(len(x[0]) for x in rows):
                c = [np.concatenate(x) for x in zip(*rows)]
                c[3], c[5] = c[3].astype(np.int32), c[5].astype(np.int32)
                yield _table(_RUNS, c)
            # what the next batch needs
            tail = key == key[-1]
            if number[-1] == 1:
                hold = np.flatnonzero(tail & ~later)
                kept = (rid[hold], doc[hold], lo[hold], n[hold], key[hold], np.zeros(len(hold), np.int64))
                waiting = [*waiting, kept] if carry and not new_key.any() else [kept]
            else:
                waiting = None
            last = (key[-1], seg[-1], head_doc[-1], head_lo[-1])
            ordinal = int(number[-1])
    return task


def _bytes_of_runs(threshold: int):
    """Rows (text, runs of it) to rows (key, part, rid, doc, lo, bytes of the run)."""
    schema = "key long, part int, rid long, doc long, lo long, bytes binary"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for rid, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                data = _unpack(text)
                for run in runs:
                    out.append((run["key"], run["part"], rid, run["doc"], run["lo"],
                                data[run["lo"]:run["lo"] + run["n"] - 1 + threshold]))
                if len(out) >= _BATCH:
                    yield _table(schema, zip(*out))
                    out = []
            if out:
                yield _table(schema, zip(*out))
    return task, schema


_WINDOWS = "rid long, doc long, lo long, n int, w1 long, w2 long"


def _windows(threshold: int):
    """Over open runs sorted by (key, part): spans whose windows repeat in their group.

    Rows with n > 0 are spans. In a key cut into parts the first window of each
    rank comes out too, n = 0 with its 128-bit rank, to meet those of other parts.
    """
    def settle(rows: list) -> Iterator[pa.RecordBatch]:
        key, part, rid, doc, lo, data, cut = rows
        size = np.fromiter((len(x) for x in data), np.int64, len(data))
        starts = np.concatenate(([0], np.cumsum(size)))
        buf = np.frombuffer(b"".join(data), np.uint8)
        n = size - threshold + 1
        row = np.repeat(np.arange(len(n)), n)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = starts[row] + inner
        w1 = tb.Names(buf, 0).of(at, at + threshold)
        w2 = tb.Names(buf, 1).of(at, at + threshold)
        w_doc, w_lo = doc[row], lo[row] + inner
        order = np.lexsort((w_lo, w_doc, part[row], w2, w1))
        a, b, p, d, s = w1[order], w2[order], part[row][order], w_doc[order], w_lo[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (p[1:] != p[:-1])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (d != d[lead]) | (s != s[lead])
        hit = np.sort(order[later])
        if len(hit):
            r, i = row[hit], inner[hit]
            edge = np.ones(len(hit), bool)
            edge[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1] + 1)
            f = np.flatnonzero(edge)
            z = np.zeros(len(f), np.int64)
            yield _table(_WINDOWS, (rid[r[f]], doc[r[f]], lo[r[f]] + i[f],
                                    np.diff(np.append(f, len(hit))).astype(np.int32), z, z))
        meet = order[~later & cut[row][order]]
        if len(meet):
            r = row[meet]
            yield _table(_WINDOWS, (rid[r], w_doc[meet], w_lo[meet], np.zeros(len(meet), np.int32),
                                    _i64(w1[meet]), _i64(w2[meet])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            # the last group may go on in the next batch
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            end = len(same) - int(same.sum())
            if end:
                yield from _in_groups([c[:end] for c in now], settle)
            held = [c[end:] for c in now]
        if held is not None and len(held[0]):
            yield from _in_groups(held, settle)
    return task


def _in_groups(rows: list, settle, most: int = 20_000):
    """Call ``settle`` on whole (key, part) groups, about ``most`` runs at a time."""
    key, part = rows[0], rows[1]
    edge = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
    edge = np.append(edge, len(key))
    lo = 0
    while lo < len(key):
        hi = int(edge[min(np.searchsorted(edge, lo + most), len(edge) - 1)])
        yield from settle([c[lo:hi] for c in rows])
        lo = hi


def _unpack(data: bytes | None) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text column compressed for the shuffle (z): lz4 keeps half of what zstd saves."""
    import zstandard
    c = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        rest = [k for k in batch.schema.names if k != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in rest),
             pa.array([c.compress(x.as_py() or b"") for x in texts], pa.binary())], [*rest, "z"])


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """Spans to remove: (rid, spans array<struct<lo, hi>>), one row per row key that has any.

    ``rid`` is ``row_key`` of the document row; spans are byte ranges, and may overlap.
    """
    if not 1 <= gram <= threshold:
        raise ValueError("gram must lie between 1 and threshold")
    keyed = docs.select(row_key().alias("rid"), F.col("doc_id").cast("long").alias("doc"), F.col("text"))
    pairs = keyed.mapInArrow(_pairs(threshold, gram), _PAIRS)
    runs = stage(pairs.repartition("key").sortWithinPartitions("key", "seg", "doc", "lo", "rid")
                 .mapInArrow(_rerank(group_rows), _RUNS), "runs")
    opened = (runs.filter("part >= 0").groupBy("rid")
              .agg(F.collect_list(F.struct("key", "part", "doc", "lo", "n")).alias("runs")))
    # one text a row key, whatever the number of equal rows
    texts = (docs.select(row_key().alias("rid"), "text").mapInArrow(_packed, "rid long, z binary")
             .groupBy("rid").agg(F.first("z").alias("z")))
    cut, schema = _bytes_of_runs(threshold)
    once = texts.join(opened, "rid").select("rid", "z", "runs")
    parts = runs.filter("part > 0").select("key").distinct().withColumn("cut", F.lit(True))
    open_bytes = (once.mapInArrow(cut, schema)
                  .join(parts, "key", "left")
                  .select("key", "part", "rid", "doc", "lo", "bytes", F.coalesce("cut", F.lit(False)).alias("cut")))
    settled = stage(open_bytes.repartition("key", "part").sortWithinPartitions("key", "part", "doc", "lo")
                    .mapInArrow(_windows(threshold), _WINDOWS), "windows")
    meet = settled.filter("n = 0")
    least = meet.groupBy("w1", "w2").agg(F.min(F.struct("doc", "lo")).alias("first"))
    across = (meet.join(least, ["w1", "w2"]).filter(F.struct("doc", "lo") != F.col("first"))
              .select("rid", "lo", F.lit(1).alias("n")))
    spans = (runs.filter("part < 0").select("rid", "lo", "n")
             .unionByName(settled.filter("n > 0").select("rid", "lo", "n"))
             .unionByName(across))
    return (spans.groupBy("rid")
            .agg(F.collect_list(F.struct("lo", (F.col("lo") + F.col("n") - 1 + threshold).alias("hi"))).alias("spans")))


def _kept(digest: bool):
    """(doc fields, text, spans) to what is left of the text, and its figures."""
    def merged(spans, size: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for lo, hi in sorted((s["lo"], min(s["hi"], size)) for s in spans or ()):
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], hi))
            else:
                out.append((lo, hi))
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("z"), batch.column("spans")
            left, figures = [], []
            for i in range(batch.num_rows):
                data = _unpack(texts[i].as_py())
                cuts = merged(spans[i].as_py(), len(data))
                at, kept = 0, []
                for lo, hi in cuts:
                    kept.append(data[at:lo])
                    at = hi
                kept.append(data[at:])
                rest = b"".join(kept)
                figures.append((len(data), sum(b - a for a, b in cuts), len(cuts)))
                left.append(hashlib.sha256(rest).hexdigest() if digest else rest.decode("utf-8", "ignore"))
            rest = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] not in ("z", "spans")]
            names = [n for n in batch.schema.names if n not in ("z", "spans")]
            cols = [pa.array([f[k] for f in figures], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(left, pa.string()), *cols],
                                             [*names, "left", "n_bytes", "n_removed", "n_spans"])
    return task


def remaining(docs: DataFrame, digest: bool = False, **options) -> DataFrame:
    """One row per document row: rid, doc_id, ``left`` and n_bytes, n_removed, n_spans.

    ``left`` is the text without its repeated bytes (a character of which only a
    part remains goes too), or with ``digest`` the SHA-256 of the remaining bytes.
    """
    spans = repeated_spans(docs, **options)
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = (docs.select(row_key().alias("rid"), "doc_id", "text")
              .mapInArrow(_packed, f"rid long, doc_id {kind}, z binary"))
    return (packed.join(spans, "rid", "left")
            .mapInArrow(_kept(digest), f"rid long, doc_id {kind}, left string, n_bytes long, "
                                       "n_removed long, n_spans long"))
