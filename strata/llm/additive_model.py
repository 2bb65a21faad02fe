"""Quality classifier: a generalised additive model with pairwise interactions.

A text's log-odds are a sum of table lookups: one per feature, by the feature's
bin, and one per chosen pair of features, by both (coarser) bins. Tables are
learned by cyclic boosting: round after round, each feature in turn gets a shallow
tree (a few splits of its bins) fitted to the current gradient of the log-loss and
added to its table at a small rate. Then the pairs whose best single split on both
features would lower the loss most are boosted in the same way. Scoring adds up
the tables, vectorised over a batch of texts.

Features are counts over the whole text (lengths, shares of kinds of characters,
repetition of words, lines and windows); labels, language, source and id are none.

Fitting takes a bounded sample of the labelled rows: the ``SAMPLE`` with the
smallest hash, of which only the features (some 20 numbers) reach the driver.

Scale. Features and scores are one pass over the texts without a shuffle; the
sample of ids is bounded by ``SAMPLE`` and so may be broadcast.

Defined cases: a null text is empty and gets the features, and the score, of an
empty text; a label that is null, or an id with contradicting labels, is not learned from;
without both labels in the sample the score is the share of label 1 in it (0.5 if
there is none); repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.tables import row_key
from strata.llm.textstats import SYMBOLS, Words, distinct_per_row, duplicate_lines, repeated_window_words

SAMPLE = 20_000
BINS, COARSE = 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 80, 8
RATE = 0.1
SPLITS = 3

FEATURES = ("log_bytes", "log_words", "word_length", "symbols", "upper", "digits", "marks", "bangs", "bars",
            "non_ascii", "spaces", "same_as_previous", "distinct_words", "duplicate_lines", "repeated_windows",
            "words_per_line", "wordless_letters")

_UPPER, _LOWER = tb.byte_class(range(65, 91)), tb.byte_class(range(97, 123))
_DIGIT = tb.byte_class(range(48, 58))
_MARK = tb.byte_class([c for c in range(33, 127) if not chr(c).isalnum()])
_HIGH = tb.byte_class(range(128, 256))


def byte_counts(block: tb.Block) -> np.ndarray:
    """How often each byte stands in each row, (rows, 256)."""
    out = np.zeros((block.n, 256), np.int64)
    for i, (lo, hi) in enumerate(zip(block.starts[:-1].tolist(), block.starts[1:].tolist())):
        out[i] = np.bincount(block.data[lo:hi], minlength=256)
    return out


def features(block: tb.Block) -> np.ndarray:
    """A (rows, features) array of a block."""
    words = Words(block)
    n = block.n
    size = np.diff(block.starts).astype(float)
    count = words.n.astype(float)
    seen = byte_counts(block)
    count_of = lambda members: seen[:, members].sum(1)
    per = lambda members: count_of(members) / np.maximum(size, 1)
    letters = count_of(_UPPER | _LOWER | _HIGH)
    same = np.zeros(len(words.names), bool)
    same[1:] = (words.names[1:] == words.names[:-1]) & (words.row[1:] == words.row[:-1])
    distinct = distinct_per_row(words.row, words.names, n)
    lines = seen[:, 10] + 1
    letter_sums = np.concatenate(([0], np.cumsum((_UPPER | _LOWER | _HIGH)[block.data])))
    bare = letter_sums[words.hi] == letter_sums[words.lo]
    some = np.maximum(count, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(count), tb.per_row(words.inside, block.starts) / some, per(SYMBOLS),
        count_of(_UPPER) / np.maximum(letters, 1), per(_DIGIT), per(_MARK),
        per(tb.byte_class(b"!")), per(tb.byte_class(b"|")), per(_HIGH), per(tb.SPACE),
        tb.per_row(same, words.first) / some, distinct / some, duplicate_lines(words) / lines,
        repeated_window_words(words) / some, np.log1p(count / lines), tb.per_row(bare, words.first) / some])


def _best_splits(g: np.ndarray, h: np.ndarray, splits: int) -> np.ndarray:
    """Values by bin of a tree with ``splits`` greedy splits of sums of gradient and weight."""
    cg, ch = np.concatenate(([0.0], np.cumsum(g))), np.concatenate(([0.0], np.cumsum(h)))
    cuts = [0, len(g)]
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1.0)
    for _ in range(splits):
        best = (1e-9, 0)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            m = np.arange(lo + 1, hi)
            if len(m):
                gain = worth(lo, m) + worth(m, hi) - worth(lo, hi)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], lo + 1 + k)
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        out[lo:hi] = (cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + 1.0)
    return out


def _best_quarters(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of the best tree that splits both axes once, and what it gains."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    k = len(g)
    i, j = np.meshgrid(np.arange(1, k), np.arange(1, k), indexing="ij")
    quarters = [(lambda c, f=f: f(c)) for f in (
        lambda c: c[i, j], lambda c: c[i, -1] - c[i, j], lambda c: c[-1, j] - c[i, j],
        lambda c: c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j])]
    gain = sum(q(cg) ** 2 / (q(ch) + 1.0) for q in quarters) - cg[-1, -1] ** 2 / (ch[-1, -1] + 1.0)
    a, b = np.unravel_index(gain.argmax(), gain.shape)
    values = [float(q(cg)[a, b] / (q(ch)[a, b] + 1.0)) for q in quarters]
    out = np.empty_like(g)
    a, b = a + 1, b + 1
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = values
    return out, float(gain.max())


class AdditiveModel:
    """Bin edges, a table per feature, a table per chosen pair."""

    def __init__(self, base: float, width: int):
        self.base = base
        self.edges = [np.zeros(0)] * width
        self.coarse = [np.zeros(0)] * width
        self.tables = [np.zeros(1) for _ in range(width)]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def _bins(self, x: np.ndarray, edges) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        p = float(y.mean()) if len(y) else 0.5
        if not len(y) or p in (0.0, 1.0):
            model = cls(np.log(max(p, 1e-9) / max(1 - p, 1e-9)), x.shape[1] if x.ndim == 2 else len(FEATURES))
            return model
        model = cls(np.log(p / (1 - p)), x.shape[1])
        model.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        model.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, COARSE + 1)[1:-1])) for c in x.T]
        fine, rough = model._bins(x, model.edges), model._bins(x, model.coarse)
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        z = np.full(len(y), model.base)
        for _ in range(ROUNDS):
            for k, b in enumerate(fine):
                q = 1 / (1 + np.exp(-z))
                n = len(model.tables[k])
                step = RATE * _best_splits(np.bincount(b, y - q, n), np.bincount(b, q * (1 - q), n), SPLITS)
                model.tables[k] += step
                z += step[b]
        q = 1 / (1 + np.exp(-z))
        ranked = []
        for i in range(x.shape[1]):
            for j in range(i + 1, x.shape[1]):
                ranked.append((model._quarters(rough[i], rough[j], y - q, q * (1 - q))[1], i, j))
        for _, i, j in sorted(ranked, reverse=True)[:PAIRS]:
            model.pairs.append((i, j, np.zeros((COARSE, COARSE))))
        for _ in range(PAIR_ROUNDS):
            for i, j, table in model.pairs:
                q = 1 / (1 + np.exp(-z))
                step = RATE * model._quarters(rough[i], rough[j], y - q, q * (1 - q))[0]
                table += step
                z += step[rough[i], rough[j]]
        return model

    @staticmethod
    def _quarters(a, b, g, h):
        at = a * COARSE + b
        return _best_quarters(np.bincount(at, g, COARSE * COARSE).reshape(COARSE, COARSE),
                              np.bincount(at, h, COARSE * COARSE).reshape(COARSE, COARSE))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for table, b in zip(self.tables, self._bins(x, self.edges)):
            z += table[b]
        rough = self._bins(x, self.coarse)
        for i, j, table in self.pairs:
            z += table[rough[i], rough[j]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(batch.column("text")):
            x = features(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid").slice(block.lo, block.n), batch.column("label").slice(block.lo, block.n),
                 pa.array(list(x), pa.list_(pa.float64()))], ["rid", "label", "x"])


def sampled_labels(labels: DataFrame, column: str, training: Column, sample: int) -> DataFrame:
    """(doc_id, label) of the labelled ids with the smallest hash, ``sample`` at most."""
    return (labels.filter(training & F.col("doc_id").isNotNull() & F.col(column).isNotNull())
            .groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("other"))
            .filter("label = other").select("doc_id", F.col("label").cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def learn(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE,
          column: str = "quality") -> AdditiveModel:
    """A model from labelled documents whose id meets ``training``."""
    chosen = F.broadcast(sampled_labels(labels, column, training, sample))
    rows = (docs.select(row_key().alias("rid"), "doc_id", "text").join(chosen, "doc_id")
            .select("rid", "label", "text").mapInArrow(_featured, "rid long, label int, x array<double>")
            .dropDuplicates(["rid"]).orderBy("rid").limit(2 * sample).collect())
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    return AdditiveModel.fit(x, np.array([float(r.label > 0) for r in rows]))


def _scored(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: AdditiveModel = shared.value
        for batch in batches:
            for block in tb.blocks(batch.column("text")):
                rest = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(block.lo, block.n) for c in rest),
                     pa.array(model.score(features(block)))], [*rest, "score"])
    return task


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """One row per document row: rid, doc_id, score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return (docs.select(row_key().alias("rid"), "doc_id", "text")
            .mapInArrow(_scored(shared), f"rid long, doc_id {kind}, score double"))
