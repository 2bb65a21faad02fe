"""Quality rules by tokeniser fertility: how well public vocabularies fit a text.

Words are ``[^\\x20\\x09-\\x0D]+``. Each text is tokenised word by word with two
public vocabularies (a piece model with byte fallback, a byte-level BPE for many
languages), and measured by

* characters per token of either vocabulary,
* the share of byte-fallback tokens of the piece model,
* the entropy of its tokens, in bits.

A document is rejected if a measure lies outside its band. Bands belong to a
language, a script (of most letters) and an octave of length (entropy grows with
length); a group of under ``GROUP`` documents goes by its language and script, by its
script alone, or by all documents. A band is the median with ``reach`` times the distance to either
quartile, at least ``floor``, taken over all documents of the group that pass the
base rules. Base rules: at least ``min_words`` words, and at most ``max_repeat``
percent of words inside repeated 3-word windows.

Scale. One pass over the texts makes a row of figures for each document. Quartiles
come from counts by bin of 1/``BINS`` (a grouped count that combines before its
shuffle), so no group is gathered anywhere and the result does not depend on
partitioning. Bands are joined back on their group, broadcast if they are at most
``FEW_BANDS`` (as many as there are languages, scripts and octaves of length).

Defined cases: null and empty texts have no words and fail the base rules; words
of any length are tokenised whole; a null language is
``unknown``; where a group has no spread, the floors keep everything near the
median; where no document passes the base rules there is no band; repeated rows each get a row; other columns pass through.
"""

from __future__ import annotations

import base64
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.tables import row_key, stage
from strata.llm.textstats import SYMBOLS, Words, duplicate_lines, repeated_window_words

VOCABULARIES = "/opt/tokenizers"
PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
MIN_WORDS, MAX_REPEAT = 50, 50
REACH = 4.0
BINS = 256
#: groups whose documents share a band, finest first, and how many a group needs
LEVELS = (("lang", "script", "octave", "every"), ("lang", "script"), ("script",), ("every",))
GROUP = 100
#: bands up to which they are broadcast (a few hundred bytes each); more are joined by Spark's own choice
FEW_BANDS = 10_000
#: least half-width of a band, by measure
FLOORS = {"chars_per_piece": 0.25, "chars_per_bpe": 0.25, "fallback": 0.02, "entropy": 0.4}

_MEASURED = ("rid long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "n_pieces long, n_bpe long, n_fallback long, entropy double, script string")

#: lead bytes of letters by script
SCRIPTS = (
    ("latin", [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]),
    ("greek", [0xCE, 0xCF]),
    ("cyrillic", range(0xD0, 0xD4)),
    ("armenian-hebrew", [0xD5, 0xD6, 0xD7]),
    ("arabic", range(0xD8, 0xDC)),
    ("indic", [0xE0]),
    ("south-east", [0xE1]),
    ("kana-cjk", range(0xE3, 0xEA)),
    ("hangul", range(0xEA, 0xEE)),
)


class WordCache:
    """Token ids of words met before, by name: a table of one word a slot, bounded in memory."""

    SLOTS, TOKENS = 1 << 19, 1 << 22

    def __init__(self):
        self.name = np.zeros(self.SLOTS, tb.U64)
        self.start = np.zeros(self.SLOTS, np.int64)
        self.size = np.zeros(self.SLOTS, np.int64)
        self.bpe = np.zeros(self.SLOTS, np.int64)
        self.flat = np.zeros(self.TOKENS, np.int32)
        self.used = 0

    def slots(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (names & tb.U64(self.SLOTS - 1)).astype(np.int64)
        return at, self.name[at] == names

    def put(self, names: np.ndarray, flat: np.ndarray, size: np.ndarray, bpe: np.ndarray) -> None:
        if self.used + len(flat) > self.TOKENS:
            if len(flat) > self.TOKENS:
                return
            self.name[:] = 0
            self.used = 0
        at, _ = self.slots(names)
        self.flat[self.used:self.used + len(flat)] = flat
        self.name[at], self.size[at], self.bpe[at] = names, size, bpe
        self.start[at] = self.used + np.cumsum(size) - size
        # of words that share a slot only the last written is right in all columns
        self.used += len(flat)


class Vocabularies:
    """The two tokenisers, loaded once in a Python worker."""

    _loaded: dict[str, Vocabularies] = {}

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))
        with open(os.path.join(folder, BYTES), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # words come one by one, so only the split of a word from its space matters
        self.bpe = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.known = WordCache()
        n = self.pieces.get_piece_size()
        self.is_byte = np.fromiter((self.pieces.is_byte(i) for i in range(n)), bool, n)

    @classmethod
    def of(cls, folder: str) -> Vocabularies:
        if folder not in cls._loaded:
            cls._loaded[folder] = cls(folder)
        return cls._loaded[folder]


def _encoded(words: list[bytes], voc: Vocabularies):
    """Piece ids of distinct words (flat, with counts), and their number of BPE tokens."""
    texts = [w.decode("utf-8", "replace") for w in words]
    ids = voc.pieces.encode(texts, num_threads=1)
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(size.sum()))
    encode = voc.bpe.encode_ordinary
    return flat, size, np.fromiter((len(encode(" " + t)) for t in texts), np.int64, len(texts))


def _tokens(words: Words, voc: Vocabularies):
    """Per row: pieces, BPE tokens, byte-fallback pieces, entropy of the pieces."""
    n = words.block.n
    if not len(words.names):
        z = np.zeros(n, np.int64)
        return z, z, z, np.zeros(n)
    names, index, back = np.unique(words.names, return_index=True, return_inverse=True)
    at, hit = voc.known.slots(names)
    size, bpe = voc.known.size[at], voc.known.bpe[at]
    token = np.concatenate((voc.known.flat[:voc.known.used], np.zeros(0, np.int32)))
    start = voc.known.start[at]
    new = np.flatnonzero(~hit)
    if len(new):
        data = words.block.data.tobytes()
        lo, hi = words.lo[index[new]].tolist(), words.hi[index[new]].tolist()
        flat, size[new], bpe[new] = _encoded([data[a:b] for a, b in zip(lo, hi)], voc)
        start[new] = len(token) + np.cumsum(size[new]) - size[new]
        token = np.concatenate((token, flat.astype(np.int32)))
        voc.known.put(names[new], flat, size[new], bpe[new])
    own = size[back]
    row = np.repeat(words.row, own)
    token = token[np.repeat(start[back], own) + np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)]
    pieces = np.bincount(row, minlength=n)
    fallback = np.bincount(row[voc.is_byte[token]], minlength=n)
    key = np.sort((row << 20) | token.astype(np.int64))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    f = np.flatnonzero(new)
    c = np.diff(np.append(f, len(key)))
    weight = np.bincount(key[f] >> 20, c * np.log2(c), n)
    entropy = np.where(pieces > 0, np.log2(np.maximum(pieces, 1)) - weight / np.maximum(pieces, 1), 0.0)
    return pieces, np.bincount(words.row, bpe[back], n).astype(np.int64), fallback, entropy


def _measure(folder: str):
    kinds = np.zeros(256, np.int64)
    for k, (_, members) in enumerate(SCRIPTS):
        kinds[list(members)] = k + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch.column("text")):
                voc = Vocabularies.of(folder)
                words = Words(block)
                lead = (block.data & 0xC0) != 0x80
                kind = kinds[block.data]
                letters = np.flatnonzero(kind)
                votes = np.bincount(tb.row_of(letters, block.starts) * 16 + kind[letters],
                                    minlength=16 * block.n).reshape(-1, 16)
                script = [(("none",) + tuple(s for s, _ in SCRIPTS))[v.argmax()] if v.any() else "none" for v in votes]
                pieces, bpe, fallback, entropy = _tokens(words, voc)
                figures = [words.n, tb.per_row(words.inside & lead, block.starts),
                           tb.per_row(SYMBOLS[block.data], block.starts), duplicate_lines(words),
                           repeated_window_words(words), pieces, bpe, fallback]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(block.lo, block.n) for k in range(batch.num_columns)
                     if batch.schema.names[k] != "text"]
                    + [pa.array(x.astype(np.int64)) for x in figures]
                    + [pa.array(entropy), pa.array(script, pa.string())],
                    [c for c in batch.schema.names if c != "text"]
                    + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_pieces", "n_bpe",
                       "n_fallback", "entropy", "script"])
        Vocabularies._loaded.clear()     # the worker's next task may be another operator's
        voc = None  # noqa: F841
        tb.release()
    return task


def measure(docs: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """One row of figures per document row, with rid, doc_id and lang."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest = _MEASURED.removeprefix("rid long, ")
    return (docs.select(row_key().alias("rid"), "doc_id", F.coalesce(F.col("lang"), F.lit("unknown")).alias("lang"), "text")
            .mapInArrow(_measure(vocabularies), f"rid long, doc_id {kind}, lang string, {rest}"))


def _values():
    n = F.greatest(F.col("n_pieces"), F.lit(1))
    return {"chars_per_piece": F.col("word_chars") / n,
            "chars_per_bpe": F.col("word_chars") / F.greatest(F.col("n_bpe"), F.lit(1)),
            "fallback": F.col("n_fallback") / n, "entropy": F.col("entropy")}


def bands(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """(lang, script, octave, band) over the documents that pass the base rules.

    ``band`` maps each measure to its low and high, taken from the finest of LEVELS
    in which the group has ``GROUP`` documents or more (the coarsest has no such need).
    """
    binned = measured.filter(~F.col("base_failed")).select(
        *LEVELS[0], F.explode(F.array(*(
            F.struct(F.lit(m).alias("measure"), F.floor(v * BINS).cast("long").alias("bin"))
            for m, v in _values().items()))).alias("x"))
    counts = stage(binned.groupBy(*LEVELS[0], "x.measure", "x.bin").agg(F.count("*").alias("n")), "fertility-bins")
    floor = F.create_map(*(F.lit(x) for p in FLOORS.items() for x in p))[F.col("measure")]
    out = measured.select(*LEVELS[0]).distinct()
    for k, level in enumerate(LEVELS):
        group = [*level, "measure"]
        upto = Window.partitionBy(*group).orderBy("bin")
        cum = (counts.groupBy(*group, "bin").agg(F.sum("n").alias("n"))
               .withColumn("upto", F.sum("n").over(upto))
               .withColumn("all", F.sum("n").over(Window.partitionBy(*group))))
        at = [F.min(F.when(F.col("upto") >= F.col("all") * q, (F.col("bin") + 0.5) / BINS)).alias(c)
              for q, c in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))]
        own = (cum.groupBy(*group).agg(*at, F.first("all").alias("all"))
               .filter(F.col("all") >= (GROUP if k < len(LEVELS) - 1 else 1))
               .withColumn("low", F.col("q2") - F.greatest(floor, reach * (F.col("q2") - F.col("q1"))))
               .withColumn("high", F.col("q2") + F.greatest(floor, reach * (F.col("q3") - F.col("q2"))))
               .groupBy(*level).agg(F.map_from_entries(F.collect_list(
                   F.struct("measure", F.struct("low", "high")))).alias(f"band{k}")))
        out = out.join(own, list(level), "left")
    names = [f"band{k}" for k in range(len(LEVELS))]
    return out.select(*LEVELS[0], F.coalesce(*names).alias("band"))


def judge(docs: DataFrame, vocabularies: str = VOCABULARIES, min_words: int = MIN_WORDS,
          max_repeat: int = MAX_REPEAT, reach: float = REACH) -> DataFrame:
    """One row per document row: the figures, base_failed, the measures outside their bands, kept."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    measured = stage(measure(docs, vocabularies).withColumn("base_failed", base)
                     .withColumn("every", F.lit("every"))
                     .withColumn("octave", F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)))).cast("int")),
                     "fertility")
    band = stage(bands(measured, reach), "bands")
    # one language may hold a third of all rows: a short list of bands meets them where they are, without a shuffle
    joined = measured.join(F.broadcast(band) if band.count() <= FEW_BANDS else band, list(LEVELS[0]), "left")
    outside = F.array_compact(F.array(*(
        F.when((v < F.col("band")[m]["low"]) | (v > F.col("band")[m]["high"]), F.lit(m))
        for m, v in _values().items())))
    return (joined.withColumn("outside", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(outside))
            .withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0)).drop("band", "octave", "every"))
