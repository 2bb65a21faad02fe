"""Referential check: fact rows whose keys find no dimension row, without a fact-sized join.

A star join drops such rows silently. Here every fact row is tested against a Bloom
filter of each dimension while it is written, and only what the filters cannot decide is
joined:

1. A dimension's keys go into a blocked Bloom filter: a key sets ``BITS`` bits of one
   64-bit word, words are grouped with ``bit_or``. A table of at most ``MAX_WORDS`` words
   (its size is bounded by that, so it is broadcast) however large the dimension; a
   larger dimension only makes the filter let more keys through.
2. The fact is joined with the words by word number and written once with the result: a
   key whose bits are not all set is an orphan for certain.
3. Of the keys let through, the distinct ones (a keys-only aggregate that combines
   before its shuffle) are anti-joined with the dimension. What is left are the filter's
   false positives, as few as the filter's rate times the orphan keys.
4. Valid rows and orphans are read from the written fact, joined with that short
   list. The result is exact at any filter size.

A null key finds no dimension row either and is an orphan with a reason of its own.
Reasons: ``<column> is null``, ``<column> not in <dimension>``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

REASONS = "orphan_of"
BITS, BITS_PER_KEY = 4, 16
MAX_WORDS = 1 << 18


@dataclass(frozen=True)
class Reference:
    """``column`` of the fact refers to ``key`` of ``dimension``, which is called ``name``."""

    column: str
    dimension: DataFrame
    key: str
    name: str

    @property
    def missing(self) -> str:
        return f"{self.column} not in {self.name}"

    @property
    def null(self) -> str:
        return f"{self.column} is null"


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    """BITS bits of a 64-bit word, by a second hash."""
    h = F.xxhash64(F.lit(7), key)
    mask = None
    for k in range(BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"),
                              F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return mask


def bloom_words(dimension: DataFrame, key: str, keys: int, max_words: int = MAX_WORDS) -> tuple[DataFrame, int]:
    """(word, bits) of a blocked Bloom filter for about ``keys`` keys, and its number of words."""
    words = 64
    while words < max_words and words * 64 < keys * BITS_PER_KEY:
        words *= 2
    words = min(words, max_words)
    filled = (dimension.filter(F.col(key).isNotNull())
              .groupBy(_word(F.col(key), words).alias("word")).agg(F.bit_or(_mask(F.col(key))).alias("bits")))
    return filled, words



def find_orphans(fact: DataFrame, references: Sequence[Reference], max_words: int = MAX_WORDS) -> DataFrame:
    """``fact`` with ``orphan_of``: the reasons why a star join would drop the row, in the order of ``references``.

    The fact's plan runs once. Its columns must not be called like the ones added here
    (``orphan_of`` and names that begin with ``__ref``).
    """
    taken = [c for c in fact.columns if c == REASONS or c.startswith("__ref")]
    if taken:
        raise ValueError(f"columns of the fact clash with the check's own: {taken}")
    flagged = fact
    for n, r in enumerate(references):
        # a dimension has one row per key: its count is what the filter is sized by
        words, size = bloom_words(r.dimension, r.key, r.dimension.count(), max_words)
        flagged = (flagged.withColumn(f"__ref{n}_word", _word(F.col(r.column), size))
                   .join(F.broadcast(words.select(F.col("word").alias(f"__ref{n}_word"), F.col("bits").alias(f"__ref{n}_bits"))),
                         f"__ref{n}_word", "left"))
        mask = _mask(F.col(r.column))
        held = F.coalesce(F.col(f"__ref{n}_bits").bitwiseAND(mask) == mask, F.lit(False))
        flagged = flagged.withColumn(f"__ref{n}", F.when(F.col(r.column).isNull(), F.lit(r.null))
                                     .when(~held, F.lit(r.missing))).drop(f"__ref{n}_word", f"__ref{n}_bits")
    written = materialize(flagged, "references")
    out = written
    for n, r in enumerate(references):
        through = written.filter(F.col(f"__ref{n}").isNull()).select(F.col(r.column).alias(f"__ref{n}_key")).distinct()
        leaked = materialize(through.join(r.dimension.select(F.col(r.key).alias(f"__ref{n}_key")), f"__ref{n}_key", "left_anti"),
                             "leaked").withColumn(f"__ref{n}_leaked", F.lit(True))
        out = (out.join(leaked, F.col(r.column) == F.col(f"__ref{n}_key"), "left")
               .withColumn(f"__ref{n}", F.when(F.col(f"__ref{n}_leaked"), F.lit(r.missing)).otherwise(F.col(f"__ref{n}")))
               .drop(f"__ref{n}_key", f"__ref{n}_leaked"))
    return out.select(*fact.columns, F.array_compact(F.array(*(F.col(f"__ref{n}") for n in range(len(references))))).alias(REASONS))


def split(fact: DataFrame, references: Sequence[Reference], max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows that a star join keeps, the others with their reasons); the two partition the fact."""
    checked = find_orphans(fact, references, max_words)
    return checked.filter(F.size(REASONS) == 0).drop(REASONS), checked.filter(F.size(REASONS) > 0)


def orphan_counts(orphans: DataFrame) -> dict[str, int]:
    """Rows by reason, for the audit."""
    rows = orphans.select(F.explode(REASONS).alias("reason")).groupBy("reason").count().collect()
    return {r["reason"]: r["count"] for r in sorted(rows, key=lambda r: r["reason"])}
