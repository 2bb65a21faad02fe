"""Toxicity by compression distance: which of two zstandard dictionaries explains a window better.

A text is a sequence of words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, lower-cased in
A-Z), cut into windows of ``WINDOW`` words over its whole length. A window is
compressed twice, with a dictionary of ordinary text and with one of toxic text;
the bytes that the toxic one saves are the window's distance. A document counts by
its largest distance, turned into a probability by a monotone calibration.

Words are compressed as codes: 4 bytes for each of their first 4, 5 and 7 bytes
and 4 for the whole. On plain bytes a match costs as much as a short word is long,
and chance matches inside other words make lengths jitter by as much as a toxic
word saves; as codes, words either match or do not, and stems match under any
ending.

Dictionaries. That of ordinary text holds its ``BASE`` most frequent words. That of
toxic text begins with the same words, so that what all texts share costs the same under
either, and goes on with all code strings that lean to toxic text: codes found in
clearly more toxic than ordinary documents (a log-likelihood ratio of ``LEAN`` or more, at
least four times the share), joined where they are neighbours in a word.

Learning takes a bounded sample of the labelled rows, the ``SAMPLE`` with the
smallest hash. Two thirds of it make the dictionaries, one third the calibration
(isotonic, over documents the dictionaries have not seen).

Scale. Scoring is one pass over the texts without a shuffle; the dictionaries are
bounded by the sample and go out with the task.

Defined cases: a null or wordless text has the distance 0, and the score of that;
labels that are null or contradict each other are not learned from; if a label is
missing in the sample, the score is the share of toxic rows in it (0 without rows);
repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.additive_model import sampled_labels
from strata.llm.tables import row_key

SAMPLE = 6000
WINDOW = 16
STEMS = (4, 5, 7)
WIDTH = 4 * (len(STEMS) + 1)
#: words of the shared base, and how clearly a code must lean to toxic text
BASE = 1250
LEAN = 20.0
LEVEL = 6


def word_codes(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """Codes (words, stems + 1) of a block, and each row's first word."""
    data = tb.LOWER[block.data]
    lo, hi = tb.runs(~tb.NOT_ALNUM[data], block.starts)
    names = tb.Names(data, 0)
    codes = [(names.of(lo, np.minimum(lo + k, hi)) >> tb.U64(32)).astype(np.uint32) for k in STEMS]
    codes.append((names.of(lo, hi) >> tb.U64(7)).astype(np.uint32))
    return np.column_stack(codes), np.searchsorted(lo, block.starts)


class Compressors:
    """The two compressors of a model."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard
        made = []
        for content in (ordinary, toxic):
            p = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
        self.ordinary, self.toxic = made

    def distances(self, codes: np.ndarray) -> list[int]:
        """Bytes saved by the toxic dictionary, window by window."""
        data, step = codes.tobytes(), WINDOW * WIDTH
        cut = [data[i:i + step] for i in range(0, len(data), step)]
        return [len(self.ordinary(w)) - len(self.toxic(w)) for w in cut]


class ToxicityModel:
    def __init__(self, ordinary: bytes = b"", toxic: bytes = b"", at=(0.0,), value=(0.0,)):
        self.ordinary, self.toxic = ordinary, toxic
        self.at, self.value = np.array(at, float), np.array(value, float)

    def score(self, distance: np.ndarray) -> np.ndarray:
        return np.interp(distance, self.at, self.value)

    @classmethod
    def fit(cls, texts: list[np.ndarray], toxic: np.ndarray) -> ToxicityModel:
        """From the codes of distinct documents and their labels."""
        share = float(toxic.mean()) if len(toxic) else 0.0
        held = np.arange(len(texts)) % 3 == 2
        known = [[texts[i] for i in np.flatnonzero(~held & (toxic == label))] for label in (0, 1)]
        if not known[0] or not known[1]:
            return cls(value=(share,))
        model = cls(*_dictionaries(*known))
        press = Compressors(model.ordinary, model.toxic)
        for part in (held, np.ones(len(texts), bool)):  # without both labels in the third, all of it
            if len(set(toxic[part])) == 2:
                d = np.array([max(press.distances(texts[i]), default=0) for i in np.flatnonzero(part)], float)
                model.at, model.value = _isotonic(d, toxic[part].astype(float))
                break
        return model


def _counts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    own = [np.unique(t) for t in texts]
    return np.unique(np.concatenate(own), return_counts=True)


def _log_likelihood(k, n, p):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(k > 0, k * np.log(np.maximum(p, 1e-300)), 0) + np.where(
            n - k > 0, (n - k) * np.log(np.maximum(1 - p, 1e-300)), 0)


def _leaning(own: list[np.ndarray], other: list[np.ndarray]) -> Counter:
    """Code strings that lean to ``own``: codes found in clearly more of its documents (a log-likelihood ratio of
    LEAN or more, at least four times the share), joined where they are neighbours in a word, with their number."""
    n1, n0 = len(own), len(other)
    mark, a = _counts(own)
    code, b = _counts(other)
    if not len(mark) or not len(code):
        return Counter()
    at = np.minimum(np.searchsorted(code, mark), len(code) - 1)
    b = np.where(code[at] == mark, b[at], 0)
    both = (a + b) / (n0 + n1)
    ratio = 2 * (_log_likelihood(a, n1, a / n1) + _log_likelihood(b, n0, b / n0)
                 - _log_likelihood(a, n1, both) - _log_likelihood(b, n0, both))
    lean = mark[(a >= 3) & (a / n1 > 4 * (b + 0.5) / n0) & (ratio >= LEAN)]
    strings: Counter = Counter()
    for codes in own:
        hit = np.isin(codes, lean)
        for i in np.flatnonzero(hit.any(1)):
            k = np.flatnonzero(hit[i])
            strings[codes[i, k[0]:k[-1] + 1].tobytes()] += 1
    return strings


def _dictionaries(ordinary: list[np.ndarray], toxic: list[np.ndarray]) -> tuple[bytes, bytes]:
    """Of ordinary text its most frequent words; of toxic text these and all strings that lean to it.

    The most frequent stand last, where offsets are cheapest.
    """
    common: Counter = Counter()
    for codes in ordinary:
        common.update(map(bytes, np.ascontiguousarray(codes).view(f"V{WIDTH}").reshape(-1).tolist()))

    def laid(strings) -> bytes:
        return b"".join(s for s, n in sorted(strings, key=lambda x: (x[1], x[0])))
    base = laid(_most(common, BASE))
    return base, base + laid(_leaning(toxic, ordinary).items())


def _most(counts: Counter, n: int) -> list:
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled shares of 1 that rise with x; a smoothed share where few were seen."""
    at, back = np.unique(x, return_inverse=True)
    pools = [[a, a, s, n] for a, s, n in zip(at, np.bincount(back, y), np.bincount(back))]
    out: list[list] = []
    for p in pools:
        out.append(p)
        while len(out) > 1 and out[-2][2] / out[-2][3] >= out[-1][2] / out[-1][3]:
            b = out.pop()
            out[-1] = [out[-1][0], b[1], out[-1][2] + b[2], out[-1][3] + b[3]]
    mean = y.mean()
    points = [(e, (s + mean) / (n + 1)) for lo, hi, s, n in out for e in ((lo, hi) if hi > lo else (lo,))]
    value = np.maximum.accumulate([v for _, v in points])
    return np.array([a for a, _ in points]), value


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(batch.column("text")):
            codes, first = word_codes(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid").slice(block.lo, block.n), batch.column("label").slice(block.lo, block.n),
                 pa.array([codes[first[i]:first[i + 1]].tobytes() for i in range(block.n)], pa.binary())],
                ["rid", "label", "codes"])


def learn(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE,
          column: str = "toxic") -> ToxicityModel:
    """A model from labelled documents whose id meets ``training``."""
    chosen = F.broadcast(sampled_labels(labels, column, training, sample))
    rows = (docs.select(row_key().alias("rid"), "doc_id", "text").join(chosen, "doc_id")
            .select("rid", "label", "text").mapInArrow(_coded, "rid long, label int, codes binary")
            .dropDuplicates(["codes"]).orderBy("rid").limit(2 * sample).collect())
    texts = [np.frombuffer(bytes(r.codes), np.uint32).reshape(-1, len(STEMS) + 1) for r in rows]
    return ToxicityModel.fit(texts, np.array([int(r.label > 0) for r in rows], int))


def _scored(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel = shared.value
        press = Compressors(model.ordinary, model.toxic) if model.ordinary else None
        for batch in batches:
            for block in tb.blocks(batch.column("text")):
                codes, first = word_codes(block)
                far = [press.distances(codes[first[i]:first[i + 1]]) if press else [] for i in range(block.n)]
                top = [max(d, default=0) for d in far]
                at = [d.index(m) * WINDOW if d else None for d, m in zip(far, top)]
                rest = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(block.lo, block.n) for c in rest),
                     pa.array(model.score(np.array(top, float))), pa.array(top, pa.int64()), pa.array(at, pa.int64())],
                    [*rest, "score", "distance", "at_word"])
    return task


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per document row: rid, doc_id, score, distance, at_word (start of the farthest window)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(row_key().alias("rid"), "doc_id", "text")
            .mapInArrow(_scored(shared), f"rid long, doc_id {kind}, score double, distance long, at_word long"))
