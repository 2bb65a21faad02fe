"""Language ID by a byte convolutional network, trained and applied in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes, the last padded
with zeros. A filter of width w adds up w weights, one for the byte at each place;
widths 2, 3 and 4 slide over the window, each filter keeps its maximum, and a
softmax layer turns the maxima into probabilities of the languages. A text's
probabilities are the softmax of the mean of its windows' log-probabilities, so
every byte counts, wherever it stands.

Training: Adam on windows of a bounded sample of labelled documents
(``PER_LANGUAGE`` documents in expectation of each language, of more than ``LANGUAGES``
languages fewer, ``WINDOWS`` windows each at most), drawn by hash; seeds fixed,
so the same documents give the same network.

Scale. The network (about 40 k numbers) goes out with the task; scoring is one pass
without a shuffle, on batches of windows of fixed shape, so memory does not depend
on the length of a text beyond its own bytes. Applied, the weights of two
neighbouring bytes are added up beforehand in a table of byte pairs.

Defined cases: ``und`` with score 0 where the text is null or has no letter, or
where nothing could be learned; rows without a language are not learned from;
repeated rows count once in training; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textblocks as tb
from strata.llm.tables import row_key

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANGUAGE = 800
WINDOWS = 3
#: tables of more languages learn from fewer documents of each, but from no fewer than LEAST
LANGUAGES = 256
LEAST = 20
STEPS, BATCH, RATE = 400, 128, 0.02
SEED = 10
UNKNOWN = "und"


class Net:
    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.conv = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.base = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.conv, self.bias, self.out, self.base]

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maxima of all filters over windows ``x`` (n, WINDOW), and where they stand."""
        one = x.T.astype(np.int64)  # places first, as in scoring
        tops, places = [], []
        for k, w in enumerate(WIDTHS):
            n = len(one) - w + 1
            y = np.take(self.conv[k][0], one[:n], 0, mode="clip")
            for j in range(1, w):
                y += np.take(self.conv[k][j], one[j:n + j], 0, mode="clip")
            top = y.max(0)
            places.append((y == top).argmax(0))
            tops.append(top + self.bias[k])
        return np.concatenate(tops, 1), places

    def step(self, x: np.ndarray, y: np.ndarray, adam: list, t: int, rate: float) -> float:
        pooled, places = self.pooled(x)
        hidden = np.maximum(pooled, 0)
        p = _softmax(hidden @ self.out + self.base)
        n = len(x)
        loss = float(-np.log(p[np.arange(n), y] + 1e-9).mean())
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.out.T) * (pooled > 0)
        grads = []
        for k, w in enumerate(WIDTHS):
            own = back[:, k * FILTERS:(k + 1) * FILTERS]
            g = np.zeros_like(self.conv[k])
            f = np.broadcast_to(np.arange(FILTERS), own.shape)
            for j in range(w):
                byte = np.take_along_axis(x, places[k] + j, 1)
                np.add.at(g[j], (byte, f), own)
            grads.append(g)
        grads += [back.sum(0).reshape(len(WIDTHS), FILTERS), hidden.T @ p, p.sum(0)]
        for a, g, (m, v) in zip(self.parameters(), grads, adam):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        return loss

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Net:
        rng = np.random.default_rng(seed + 1)
        adam = [(np.zeros_like(a), np.zeros_like(a)) for a in self.parameters()]
        # every language is drawn as often as the others
        members = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        for t in range(1, steps + 1):
            pick = np.array([rng.choice(members[k]) for k in rng.integers(0, len(members), BATCH)])
            batch = x[pick].copy()
            for i in np.flatnonzero(rng.random(BATCH) < 0.25):  # short texts are mostly padding
                batch[i, rng.integers(8, WINDOW):] = 0
            self.step(batch, y[pick], adam, t, RATE * (1 - t / (steps + 1)))
        return self

    def tables(self):
        """Weights for scoring, with those of two neighbouring bytes added up."""
        pair = []
        for k, w in enumerate(WIDTHS):
            own = []
            for j in range(0, w - 1, 2):
                own.append((self.conv[k][j][:, None] + self.conv[k][j + 1][None]).reshape(65536, FILTERS))
            pair.append((own, self.conv[k][w - 1] if w % 2 else None))
        return pair

    def log_probabilities(self, x: np.ndarray, tables) -> np.ndarray:
        x = x.T  # places first: lookups and maxima then run over contiguous rows
        one = x.astype(np.int64)
        two = (one[:-1] << 8) | one[1:]
        tops = []
        for k, w in enumerate(WIDTHS):
            n = len(x) - w + 1
            own, last = tables[k]
            y = np.take(own[0], two[:n], 0, mode="clip")
            for j, table in enumerate(own[1:], 1):
                y += np.take(table, two[2 * j:2 * j + n], 0, mode="clip")
            if last is not None:
                y += np.take(last, one[w - 1:w - 1 + n], 0, mode="clip")
            tops.append(y.max(0) + self.bias[k])
        z = np.maximum(np.concatenate(tops, 1), 0) @ self.out + self.base
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def windows(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a block (n, WINDOW), and the row of each."""
    size = np.diff(block.starts)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(block.n), n)
    start = block.starts[row] + WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
    at = start[:, None] + np.arange(WINDOW)
    inside = at < block.starts[row + 1][:, None]
    if not len(block.data):
        return np.zeros((0, WINDOW), np.uint8), row
    return np.where(inside, block.data[np.minimum(at, len(block.data) - 1)], 0).astype(np.uint8), row


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few windows of each text, chosen by its key."""
    for batch in batches:
        keys = batch.column("rid").to_numpy(zero_copy_only=False)
        langs, out = [], []
        for block in tb.blocks(batch.column("text")):
            x, row = windows(block)
            first = np.searchsorted(row, np.arange(block.n + 1))
            for i in range(block.n):
                n = int(first[i + 1] - first[i])
                rng = np.random.default_rng(int(keys[block.lo + i]) & 0xFFFFFFFF)
                for k in sorted(rng.permutation(n)[:WINDOWS]) if n else ():
                    langs.append(batch.column("lang")[block.lo + i].as_py())
                    out.append(x[first[i] + k].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "w"])


def learn(docs: DataFrame, training: Column, per_language: int = PER_LANGUAGE, steps: int = STEPS) -> Net | None:
    """A network from the rows where ``training`` holds and lang is given."""
    known = docs.filter(training & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        row_key().alias("rid"), "lang", "text")
    counts = (known.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.col("n").desc(), "lang").collect())
    if not counts:
        return None
    per_language = min(per_language, max(LEAST, per_language * LANGUAGES // len(counts)))
    rate = F.create_map(*(F.lit(x) for r in counts for x in (r.lang, min(1.0, per_language / r.n))))
    unit = F.pmod(F.xxhash64(F.lit(SEED), "rid"), F.lit(1 << 30)) / (1 << 30)
    rows = sorted(known.filter(unit < rate[F.col("lang")]).mapInArrow(_drawn, "lang string, w binary")
                  .distinct().collect())
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    number = {x: i for i, x in enumerate(languages)}
    x = np.frombuffer(b"".join(bytes(r.w) for r in rows), np.uint8).reshape(-1, WINDOW)
    return Net(languages).train(x, np.array([number[r.lang] for r in rows]), steps)


def _predict(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Net = shared.value
        tables = net.tables()
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for block in tb.blocks(batch.column("text")):
                x, row = windows(block)
                total = np.zeros((block.n, len(net.languages)))
                for lo in range(0, len(x), 256):
                    part = net.log_probabilities(x[lo:lo + 256], tables)
                    np.add.at(total, row[lo:lo + 256], part)
                n = np.maximum(np.bincount(row, minlength=block.n), 1)
                p = _softmax(total / n[:, None])
                best = p.argmax(1)
                known = letters[block.lo:block.hi].astype(bool)
                lang = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
                rest = [c for c in batch.schema.names if c not in ("text", "letters")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(block.lo, block.n) for c in rest), pa.array(lang, pa.string()),
                     pa.array(np.where(known, p[np.arange(block.n), best], 0.0))], [*rest, "lang_pred", "score"])
    return task


def predict(docs: DataFrame, net: Net | None) -> DataFrame:
    """One row per document row: rid, doc_id, lang_pred, score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(row_key().alias("rid"), "doc_id", "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if net is None:
        return rows.select("rid", "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return rows.mapInArrow(_predict(shared), f"rid long, doc_id {kind}, lang_pred string, score double")
