"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, how often, and where.

Each text, behind one space, is tokenised by vocabulary A (byte-level BPE) and B (pieces
with byte fallback). Offsets where tokens of both end cut the two lists into groups;
an A and a B token whose byte ranges overlap are linked. The links of a pair of ids
over the whole corpus are its count, and a document's links are scored by the counts.

Index. Documents are numbered within chunks (about ``CHUNK_BYTES`` of text, at most
65,536 documents). A chunk holds for every pair of ids a compressed bitmap of the
documents that link it, and planes for multiplicity: plane k + 1 holds the documents
whose number of links less one has bit k. A bitmap is a sorted list of 16-bit numbers
while that is the shorter form, else its bits. The blocks of a chunk are OR-merged into
one bitmap a plane; bitmaps of different chunks are of different documents, so their OR is
their list and its popcount the sum of theirs: a pair's documents are the popcount of plane 0, its
links that plus 2^k times the popcount of plane k + 1. Postings joined with the counts
return them to the documents: every bit set in a plane adds its share of the score.

Tokenising. Neither vocabulary has a token that goes on after a space inside it, so texts are cut
before each space that follows a visible character, and each distinct segment of a task is
tokenised and aligned once. The result is that of the whole text (tested).

Scale. Python reads the texts once. What shuffles are postings, a few bytes for each pair
and chunk, twice: to their counts (partial sums before the shuffle; a pair that every chunk
holds has one posting a chunk, split by AQE), and back to their chunk, whose size is bounded.
No pair's postings and no document list is gathered anywhere.

Defined cases: texts that are null, empty, or whose joined A or B bytes differ from
space and text (U+2581 in a text, which B takes for a space) have no tokens: zeros and an
empty digest; repeated rows are documents of their own; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.tables import stage

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES, CHUNK_DOCS = 4 << 20, 1 << 16
#: distinct segments, and bytes of them, that a task goes on remembering after a chunk
SEGMENTS, SEGMENT_BYTES = 1 << 18, 8 << 20
#: ids of B in a pair's number
B_IDS = 1 << 17

#: fixed value: the split of byte-level vocabularies before their merges
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SEGMENT = re.compile(rb" +[^ ]+| +$")
# a space after one of these is no safe cut: white space (of Unicode too) may form a token with it
_UNSAFE = re.compile(rb"(?:[\x00-\x20\x7f]|\xc2[\x80-\xa0]|\xe1[\x9a\xa0].|\xe2[\x80\x81\x96].|\xe3\x80\x80)\Z", re.S)
_ANY_UNSAFE = re.compile(rb"(?:[\x00-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1[\x9a\xa0].|\xe2[\x80\x81\x96].|\xe3\x80\x80)(?: |\Z)| \Z", re.S)


def segments(text: bytes) -> list[bytes]:
    """Cut ``text``, which begins with a space, where no token of either vocabulary can go across."""
    found = _SEGMENT.findall(text)
    if not _ANY_UNSAFE.search(text):
        return found
    out = []
    for s in found:
        if out and (not s.strip(b" ") or _UNSAFE.search(out[-1])):
            out[-1] += s
        else:
            out.append(s)
    return out


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write bytes as characters: printable ones as themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """The two vocabularies, loaded once in a Python worker."""

    _loaded: dict[tuple[str, str], Pair] = {}

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters = _byte_alphabet()
        with open(a, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}
        self.ranks = self._as_ranks(a)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        top = max(self.a_bytes) + 1
        self.a_bytes = [self.a_bytes.get(i, b"") for i in range(top)]
        self.a_size = np.fromiter(map(len, self.a_bytes), np.int64, top)
        self.b_size = np.fromiter(map(len, self.b_bytes), np.int64, len(self.b_bytes))
        self.pieces = [f"{i}{c}" for i in range(max(top, len(self.b_bytes))) for c in ",|;"]
        self.piece_size = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))

    def _as_ranks(self, a: str):
        """The same vocabulary as ranks, if it lies beside the file and is the same id by id; for ASCII texts only,
        where no table of character classes can differ."""
        path = a.removesuffix(".json") + ".tiktoken"
        if not os.path.exists(path):
            return None
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        if any(self.a_bytes.get(i) != t for t, i in ranks.items()):
            return None
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, a: str, b: str) -> Pair:
        if (a, b) not in cls._loaded:
            cls._loaded[a, b] = cls(a, b)
        return cls._loaded[a, b]

    def encode(self, texts: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """(ids, number a text) of A and of B for texts that begin with a space, and where the bytes come back.

        Where they do not, a text has no ids.
        """
        strings = [t.decode("utf-8", "replace") for t in texts]
        of_a: list = [None] * len(texts)
        if self.ranks is not None:      # the same merges in a library that takes a fifth of the time
            fast = self.ranks.encode_ordinary
            of_a = [fast(t) if t.isascii() else None for t in strings]
        slow = [k for k, ids in enumerate(of_a) if ids is None]
        for k, e in zip(slow, self.a.encode_batch([strings[k] for k in slow], add_special_tokens=False)):
            of_a[k] = e.ids
        of_b = self.b.encode([t[1:] for t in strings], num_threads=1)
        flat = itertools.chain.from_iterable
        ok = np.ones(len(texts), bool)
        if not (list(map(len, texts)) == self._sizes(of_a, self.a_size) == self._sizes(of_b, self.b_size)
                and b"".join(map(self.a_bytes.__getitem__, flat(of_a))) == b"".join(texts)
                == b"".join(map(self.b_bytes.__getitem__, flat(of_b)))):
            for k, t in enumerate(texts):
                ok[k] = b"".join([self.a_bytes[i] for i in of_a[k]]) == t == b"".join([self.b_bytes[i] for i in of_b[k]])
                if not ok[k]:
                    of_a[k] = of_b[k] = []
        both = []
        for lists in (of_a, of_b):
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            both.append((np.fromiter(flat(lists), np.int64, int(n.sum())), n))
        return both[0], both[1], ok

    @staticmethod
    def _sizes(lists: list[list[int]], size: np.ndarray) -> list[int]:
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        sums = np.concatenate(([0], np.cumsum(size[np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(n.sum()))])))
        end = np.cumsum(n)
        return (sums[end] - sums[end - n]).tolist()

    def aligned(self, a: np.ndarray, b: np.ndarray, texts_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Links of texts that stand one behind the other: pair number and end, then the groups' text a text, and common ends.

        ``texts_end``: byte offsets at which the texts end. Between two neighbouring ends of any
        tokens lies one A and one B token: each such stretch is one link.
        """
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.union1d(end_a, end_b)
        pairs = a[np.searchsorted(end_a, ends)] * B_IDS + b[np.searchsorted(end_b, ends)]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        # written as ids with what stands behind each: , within a side, | after A's last, ; after B's last
        last_a, last_b = np.searchsorted(end_a, common) + 1, np.searchsorted(end_b, common) + 1
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        place_a = np.arange(len(a)) + np.concatenate(([0], last_b))[group_a]
        place_b = np.arange(len(b)) + last_a[group_b]
        piece = np.empty(len(a) + len(b), np.int64)
        piece[place_a], piece[place_b] = 3 * a, 3 * b
        piece[place_a[last_a - 1]] += 1
        piece[place_b[last_b - 1]] += 2
        text = "".join(map(self.pieces.__getitem__, piece.tolist()))
        at = np.concatenate(([0], np.cumsum(self.piece_size[piece])))
        # a text's groups end behind its last A and B token
        cut = at[np.searchsorted(end_a, texts_end, "right") + np.searchsorted(end_b, texts_end, "right")].tolist()
        return pairs, ends, [text[lo:max(lo, hi - 1)] for lo, hi in zip([0] + cut[:-1], cut)], common


# --- bitmaps ---------------------------------------------------------------------------

def bitmaps(row: np.ndarray, member: np.ndarray, rows: int, span: int) -> pa.Array:
    """One compressed bitmap a row of the members (below ``span``, ascending in their row; ``row`` ascending)."""
    card = np.bincount(row, minlength=rows)
    width = (span + 7) // 8
    dense = 2 * card >= width
    offsets = np.concatenate(([0], np.cumsum(np.where(dense, width, 2 * card))))
    out = np.zeros(int(offsets[-1]), np.uint8)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(card) - card, card)
    listed = ~dense[row]
    at = offsets[row[listed]] + 2 * rank[listed]
    m = member[listed]
    out[at] = m & 255
    out[at + 1] = m >> 8
    full = ~listed
    if full.any():
        np.bitwise_or.at(out, offsets[row[full]] + (member[full] >> 3), (1 << (member[full] & 7)).astype(np.uint8))
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])


def members(column: pa.Array, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and member of every bit set in a column of bitmaps of one span."""
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    size = np.diff(off)
    width = (span + 7) // 8
    rows, found = [], []
    listed = np.flatnonzero((size != width) & (size > 0))
    card = size[listed] // 2
    at = np.repeat(off[listed], card) + 2 * (np.arange(int(card.sum())) - np.repeat(np.cumsum(card) - card, card))
    rows.append(np.repeat(listed, card))
    found.append(data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8)
    full = np.flatnonzero(size == width)
    for lo in range(0, len(full), 256):
        some = full[lo:lo + 256]
        bits = np.unpackbits(data[off[some][:, None] + np.arange(width)], axis=1, bitorder="little")
        r, m = np.nonzero(bits)
        rows.append(some[r])
        found.append(m)
    return np.concatenate(rows), np.concatenate(found)


# --- one pass over the texts ---------------------------------------------------------------

class _Known:
    """Distinct segments: number by bytes, and per number the figures, groups and links."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.bytes = 0
        self.groups: list[str] = []
        self.figures = [np.zeros((0, 3), np.int64)]        # tokens of A and B, groups
        self.links = [np.zeros(0, np.int64)]
        self.sizes = [np.zeros(0, np.int64)]

    def learn(self, texts: list[bytes], voc: Pair) -> None:
        for lo in range(0, len(texts), 8192):
            some = texts[lo:lo + 8192]
            (a, n_a), (b, n_b), ok = voc.encode(some)
            size = np.fromiter(map(len, some), np.int64, len(some)) * ok
            end = np.cumsum(size)
            pairs, ends, groups, common = voc.aligned(a, b, end)
            links = np.diff(np.searchsorted(ends, end, "right"), prepend=0)
            first = len(self.groups)
            self.number.update((t, first + k if good else -1) for k, (t, good) in enumerate(zip(some, ok.tolist())))
            self.groups += groups
            self.figures.append(np.stack((n_a, n_b, np.diff(np.searchsorted(common, end, "right"), prepend=0)), 1))
            self.links.append(pairs)
            self.sizes.append(links)
            self.bytes += int(size.sum())

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Figures, links and the number of links, by number of the segment."""
        for name in ("figures", "links", "sizes"):
            setattr(self, name, [np.concatenate(getattr(self, name))])
        return self.figures[0], self.links[0], self.sizes[0]


class _Chunk:
    """Documents of a chunk: their segments' numbers until it is written."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.ids: list = []
        self.docs: list[list[int]] = []
        self.shas: list[str] = []
        self.known = _Known()

    def add(self, ids, texts: list[bytes], voc: Pair) -> None:
        cut = [segments(b" " + t) if t else [] for t in texts]
        known = self.known
        new = dict.fromkeys(s for c in cut for s in c if s not in known.number)
        known.learn(list(new), voc)
        for c in cut:
            numbers = [known.number[s] for s in c]
            if -1 in numbers:
                numbers = []
            self.docs.append(numbers)
            self.shas.append(hashlib.sha256(";".join([known.groups[k] for k in numbers]).encode()).hexdigest()
                             if numbers else "")
        self.ids.append(ids)
        self.bytes += sum(map(len, texts))

    def written(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n = len(self.docs)
        size = np.fromiter(map(len, self.docs), np.int64, n)
        doc = np.repeat(np.arange(n), size)
        seg = np.fromiter(itertools.chain.from_iterable(self.docs), np.int64, int(size.sum()))
        figures = self.known.flat()[0]
        sums = [np.bincount(doc, figures[seg, k], n).astype(np.int64) for k in range(3)]

        def batch(rows, **columns):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, self.number)) if f.name == "chunk" else
                 columns[f.name].cast(f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)
        ids = pa.chunked_array(self.ids).combine_chunks() if len(self.ids) > 1 else self.ids[0]
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        yield batch(n, no=pa.array(np.arange(n)), doc_id=ids, n_a=pa.array(sums[0]), n_b=pa.array(sums[1]),
                    n_groups=pa.array(sums[2]), n_links=pa.array(sums[0] + sums[1] - sums[2]), groups_sha256=pa.array(self.shas, pa.string()))
        pair, doc, times = self._links(doc, seg)
        if not len(pair):
            return
        for plane in range(64):
            if plane:
                on = np.flatnonzero((times - 1) >> (plane - 1) & 1)
                p, d = pair[on], doc[on]
                if not ((times - 1) >> (plane - 1)).any():
                    return
            else:
                p, d = pair, doc
            if not len(p):
                continue
            first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
            row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(p))))
            maps, own = bitmaps(row, d, len(first), n), p[first]
            for lo in range(0, len(first), 1 << 14):
                some = own[lo:lo + (1 << 14)]
                yield batch(len(some), pair=pa.array(some), plane=pa.array(np.full(len(some), plane)),
                            span=pa.array(np.full(len(some), n)), docs=maps.slice(lo, len(some)))

    def _links(self, doc, seg):
        """Distinct (pair, document), by pair, with their number of links."""
        if not len(seg):
            z = np.zeros(0, np.int64)
            return z, z, z
        each, times = np.unique(doc << 32 | seg, return_counts=True)
        doc, seg = each >> 32, each & 0xFFFFFFFF
        _, flat, size = self.known.flat()
        start = np.cumsum(size) - size
        parts = []
        for lo in range(0, len(seg), 1 << 17):            # blocks, merged into the chunk's bitmaps below
            s = seg[lo:lo + (1 << 17)]
            n = size[s]
            at = np.repeat(start[s], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            key = flat[at] << 16 | np.repeat(doc[lo:lo + (1 << 17)], n)
            parts.append(_added(key, np.repeat(times[lo:lo + (1 << 17)], n)))
        key, times = _added(*(np.concatenate(x) for x in zip(*parts)))
        return key >> 16, key & 0xFFFF, times


def _added(key, times):
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(times, first)


_ROW = ("chunk long, no int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pair long, plane int, span int, docs binary")


def _index(a: str, b: str, kind: pa.DataType):
    schema = pa.schema([("chunk", pa.int64()), ("no", pa.int32()), ("doc_id", kind), ("n_a", pa.int64()), ("n_b", pa.int64()),
                        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                        ("pair", pa.int64()), ("plane", pa.int32()), ("span", pa.int32()), ("docs", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = Pair.of(a, b)
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for batch in batches:
            for block in tb.blocks(batch.column("text"), CHUNK_BYTES // 4):
                if chunk.docs and (chunk.bytes + len(block.data) > CHUNK_BYTES or len(chunk.docs) + block.n > CHUNK_DOCS):
                    yield from chunk.written(schema)
                    number += 1
                    known = chunk.known
                    chunk = _Chunk(number)
                    if len(known.number) < SEGMENTS and known.bytes < SEGMENT_BYTES:
                        chunk.known = known
                chunk.add(batch.column("doc_id").slice(block.lo, block.n), [block.text(i) for i in range(block.n)], voc)
        if chunk.docs:
            yield from chunk.written(schema)
    return task


# --- counts and scores ------------------------------------------------------------------------

def _shares():
    """Documents and links that a posting stands for."""
    count = (F.when(F.octet_length("docs") == F.ceil(F.col("span") / 8), F.bitmap_count("docs"))
             .otherwise(F.octet_length("docs") / 2).cast("long"))
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    return count, weight


def _returned(kind: pa.DataType):
    """Per chunk, document rows followed by scored postings, to scored document rows."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def done(rows, best, total):
        docs = pa.Table.from_batches(rows)
        order = np.argsort(docs.column("no").to_numpy())
        docs = docs.take(pa.array(order))
        n = len(order)
        columns = {c: docs.column(c) for c in names if c not in ("n_best", "count_sum")}
        columns |= {"n_best": pa.chunked_array([pa.array(best[:n])]), "count_sum": pa.chunked_array([pa.array(total[:n])])}
        yield from pa.table([columns[c] for c in names], names).to_batches(max_chunksize=4096)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, best, total = None, [], None, None
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, [len(chunk)]))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi == lo:
                    continue
                if chunk[lo] != at:
                    if at is not None:
                        yield from done(rows, best, total)
                    at, rows = chunk[lo], []
                    best, total = np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)
                part = batch.slice(lo, hi - lo)
                posting = part.column("pair").is_valid()
                heads = part.filter(pc.invert(posting))
                if heads.num_rows:
                    rows.append(heads.select(["no", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]))
                maps = part.filter(posting)
                if maps.num_rows:
                    row, doc = members(maps.column("docs"), maps.column("span")[0].as_py())
                    share = np.left_shift(1, np.maximum(maps.column("plane").to_numpy().astype(np.int64) - 1, 0))
                    np.add.at(best, doc, (share * maps.column("is_best").to_numpy(zero_copy_only=False))[row])
                    np.add.at(total, doc, (share * maps.column("links").to_numpy())[row])
        if at is not None:
            yield from done(rows, best, total)
    return task


@dataclass(frozen=True)
class Alignment:
    """The inverted index and what it gives: ``documents`` (scored rows) and ``pairs``
    (a, b, documents, links, is_best)."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> Alignment:
    """Tokenise by the vocabulary files ``a`` and ``b``, index the pairs and score the documents."""
    if a is None or b is None:
        import public_tokenizers
        a, b = a or public_tokenizers.path(VOCABULARY_A), b or public_tokenizers.path(VOCABULARY_B)
    field = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(field)
    index = stage(docs.select("doc_id", "text").mapInArrow(_index(a, b, kind), _ROW.format(kind=field.simpleString())), "pair-bitmaps")
    postings = index.filter("pair IS NOT NULL").select("chunk", "pair", "plane", "span", "docs")
    count, weight = _shares()
    counts = stage(postings.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, count).otherwise(F.lit(0))).alias("documents"), F.sum(count * weight).alias("links")),
        "pair-counts").withColumn("b", F.col("pair") % B_IDS)
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    pairs = counts.join(most, "b").select("pair", F.expr(f"pair div {B_IDS}").alias("a"), "b", "documents", "links",
                                          (F.col("links") == F.col("most")).alias("is_best"))
    # the counts grow with the corpus: they are never broadcast, and the plan is the same at every size
    scored = postings.join(pairs.select("pair", "links", "is_best").hint("merge"), "pair")
    heads = index.filter("pair IS NULL").drop("pair", "plane", "span", "docs")
    both = (heads.unionByName(scored, allowMissingColumns=True).repartition("chunk")
            .sortWithinPartitions("chunk", F.col("pair").isNotNull()))
    out = both.mapInArrow(_returned(kind), f"doc_id {field.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
                                           "n_best long, count_sum long, groups_sha256 string")
    return Alignment(out, pairs.drop("pair"))
