"""Token counts through a digest cache: only contents never counted before are encoded.

A cache row is (content, n_tokens) under one tokenizer version. ``content`` is the
SHA-256 of a text's normalised content, the version the SHA-256 of the tokenizer file,
the library's name and release. Normalising may only do what cannot change a count.
For a vocabulary that splits at white space and lower-cases, runs of white space
become one space, outer ones go, and A-Z are lower-cased in texts that are all ASCII
and hold no ``<|`` (a special token's string counts only as it is written, and a letter
before a combining mark composes differently in either case). For all others the
content is the text as it stands.

Steps. Every row gets its digest (in the JVM). Distinct digests that the cache lacks
are the misses; one text of each is encoded, and the counts are appended to the
cache. Rows are then joined to their counts by digest. A job that dies leaves the cache
without its rows or with all of them (Spark's commit); a digest that two
jobs append at once is read as one.

Texts of a vocabulary that splits at white space are counted by their distinct words, a
piece of about 1 MB at a time, so no encoding of a whole long text is held. The
count is that of the whole text.

Scale. The rows that are joined hold a digest and two numbers. Texts of misses move once,
compressed, grouped by digest with a map-side first, so a text that holds a third of all
rows is sent once a task; misses that fit ``spark.sql.autoBroadcastJoinThreshold`` select
their texts where they are read. The last join moves narrow rows, split by AQE where
one digest is hot.

Defined cases: null is an empty text; empty texts have no tokens; repeated rows and null
ids each get a row; other columns are not read; an empty table gives no rows and leaves
the cache as it was.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.suffix_dedup import _packed, _unpack
from strata.llm.tables import stage

LIMIT = 2048
VOCABULARY = "word_bpe_49k.json"
#: bytes of a text whose words are counted at once, and words whose counts a task remembers
PART_BYTES, WORDS = 1 << 20, 1 << 19
#: words encoded in one line, by their bytes
LINE_BYTES = 1 << 15
#: longer words are not remembered
WORD_BYTES = 64

_CACHE = "content binary, n_tokens long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _library(path: str) -> str:
    return "tokenizers" if path.endswith(".json") else "sentencepiece"


def tokenizer_version(path: str) -> str:
    """Digest of everything that decides a count: the file, the library and its release."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for part in iter(lambda: f.read(1 << 20), b""):
            h.update(part)
    name = _library(path)
    h.update(f"{name} {importlib.metadata.version(name)} plain".encode())
    return h.hexdigest()


def splits_at_white_space(path: str) -> bool:
    """Whether the count of a text is the sum over its words, whatever white space or ASCII case they have.

    So it is if white space is dropped by the first split, all is lower-cased, and no added
    token takes part in either.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    first = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    return ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1].get("pattern") == {"Regex": r"\s+"} and steps[1].get("content") == " "
            and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and r"[^\s" in first.get("pattern", {}).get("Regex", "")
            and all(not (t["lstrip"] or t["rstrip"] or t["normalized"]) and t["content"].startswith("<|")
                    and not set(t["content"]) & set(" \t\n\v\f\r") for t in spec.get("added_tokens", [])))


def normalised(text: Column, by_words: bool) -> Column:
    """The content that decides a text's count."""
    text = F.coalesce(text, F.lit(""))
    if not by_words:
        return text
    flat = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    plain = ~text.rlike(r"[^\x00-\x7F]") & ~F.contains(text, F.lit("<|"))
    return F.when(plain, F.lower(flat)).otherwise(flat)


def content_digest(text: Column, by_words: bool) -> Column:
    return F.unhex(F.sha2(normalised(text, by_words), 256))


# --- counting in tasks -----------------------------------------------------------------

class Tokenizer:
    """Counts of texts, as the library gives them; loaded once in a Python worker."""

    _loaded: dict[str, Tokenizer] = {}

    def __init__(self, path: str):
        if _library(path) == "tokenizers":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer as Own
            own = Own.from_file(path)
            own.no_truncation()
            own.no_padding()
            self.counts = lambda texts: [len(e.ids) for e in own.encode_batch(texts, add_special_tokens=False)]
            # where in the text each token begins
            self.begins = lambda text: np.array(own.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)[:, 0]
        else:
            import sentencepiece
            own = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in own.encode(texts, num_threads=1)]

    @classmethod
    def of(cls, path: str) -> Tokenizer:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]


def _parts(text: bytes) -> Iterator[bytes]:
    """Pieces of about PART_BYTES that end at white space."""
    at = 0
    while len(text) - at > PART_BYTES:
        ends = [k for k in (text.find(b" ", at + PART_BYTES), text.find(b"\n", at + PART_BYTES)) if k >= 0]
        end = min(ends) if ends else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class WordCounter:
    """Counts of texts by their words; remembers short ones for the length of a task."""

    def __init__(self, path: str):
        self.begins = Tokenizer.of(path).begins
        self.known: dict[bytes, int] = {}

    def of_words(self, words: list[bytes]) -> list[int]:
        """Counts of words, encoded many in a line: a token belongs to the word it begins in."""
        out: list[int] = []
        lo = 0
        while lo < len(words):
            hi, size = lo, 0
            while hi < len(words) and (hi == lo or size < LINE_BYTES):
                size += len(words[hi])
                hi += 1
            texts = [w.decode("utf-8", "replace") for w in words[lo:hi]]
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            begins = self.begins(" ".join(texts))
            out += np.bincount(np.searchsorted(starts, begins, "right") - 1, minlength=len(texts)).tolist()
            lo = hi
        return out

    def __call__(self, text: bytes) -> int:
        total = 0
        for part in _parts(text):
            words = Counter(part.split())
            new = [w for w in words if w not in self.known]
            if len(self.known) + len(new) > WORDS:
                self.known.clear()
                new = list(words)
            once = {}
            for w, n in zip(new, self.of_words(new)):
                (self.known if len(w) <= WORD_BYTES and len(self.known) < WORDS else once)[w] = n
            total += sum((self.known[w] if w in self.known else once[w]) * n for w, n in words.items())
        return total


def _encode(path: str, by_words: bool):
    """(content, z) to (content, n_tokens)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if by_words:
            count = WordCounter(path)
        else:
            whole = Tokenizer.of(path).counts

            def count(text):
                return whole([text.decode("utf-8", "replace")])[0]
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array([count(_unpack(z.as_py())) for z in batch.column("z")], pa.int64())],
                ["content", "n_tokens"])
    return task


# --- the cache ---------------------------------------------------------------------------

def _folder(cache: str, version: str) -> str:
    return f"{cache}/tokenizer={version}"


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer version; empty where nothing is stored."""
    path = _folder(cache, version)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], _CACHE)
    return (spark.read.schema(_CACHE).parquet(path)
            .groupBy("content").agg(F.min("n_tokens").alias("n_tokens")))


def _small(spark: SparkSession, rows: int) -> bool:
    """Whether so many digests fit the size up to which Spark may broadcast."""
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 64 * rows <= limit


def count_tokens(docs: DataFrame, cache: str, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_tokens, over_limit, content.

    ``cache`` is a folder on shared storage, kept from run to run; ``path`` the vocabulary's
    file, found at the same place on every executor.
    """
    spark = docs.sparkSession
    path = path or vocabulary_path()
    by_words, version = splits_at_white_space(path), tokenizer_version(path)
    digest = content_digest(F.col("text"), by_words)
    rows = stage(docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                             digest.alias("content")), "token-rows")
    missing = stage(rows.select("content").distinct()
                    .join(stored_counts(spark, cache, version), "content", "left_anti"), "token-misses")
    n = missing.count()
    if n:
        texts = docs.select(digest.alias("content"), "text")
        if _small(spark, n):
            texts = texts.join(F.broadcast(missing), "content", "left_semi")
        once = texts.mapInArrow(_packed, "content binary, z binary").groupBy("content").agg(F.first("z").alias("z"))
        if not _small(spark, n):
            once = once.join(missing, "content", "left_semi")
        once.mapInArrow(_encode(path, by_words), _CACHE).write.mode("append").parquet(_folder(cache, version))
    counts = stored_counts(spark, cache, version)
    return (rows.join(counts, "content")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "content"))
