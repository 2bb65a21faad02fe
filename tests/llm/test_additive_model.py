import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import additive_model as am
from strata.llm import textblocks as tb

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed, n=200):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(5, 150))]
        bad = rng.random() < 0.3
        if bad:
            words = rng.choice([[w.upper() + "!!" for w in words], [w + "###" for w in words], words[:1] * len(words)])
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_accuracy_and_defined_cases(spark, docs_of):
    rows, labels = corpus(1)
    rows += [(900, None), (901, ""), (5, rows[5][1]), (None, "abc def")]
    labels += [(7, 0, 0), (7, 1, 0), (None, 1, 0), (8, None, None)]
    docs = docs_of(rows).repartition(3).selectExpr("*", "1 AS score", "2 AS label", "'x' AS rid")
    held = F.col("doc_id") % 4 == 2
    lab = spark.createDataFrame(labels, LABELS).selectExpr("*", "'y' AS text")
    model = am.learn(docs, lab, ~held)
    got = am.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[900] == by[901]
    truth = dict((d, q) for d, q, _ in labels[:200])
    assert np.mean([(by[d] >= 0.7) == truth[d] for d in range(200) if d % 4 == 2]) > 0.9


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = am.AdditiveModel.fit(x, y)
    assert any({i, j} == {0, 1} for i, j, _ in model.pairs)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95


def test_score_is_a_sum_of_lookups():
    rng = np.random.default_rng(3)
    x = rng.random((500, 3))
    model = am.AdditiveModel.fit(x, (x[:, 0] > 0.3).astype(float))
    z = []
    for r in x[:20]:
        v = model.base + sum(t[np.searchsorted(e, r[k], "right")] for k, (t, e) in enumerate(zip(model.tables, model.edges)))
        v += sum(t[np.searchsorted(model.coarse[i], r[i], "right"), np.searchsorted(model.coarse[j], r[j], "right")]
                 for i, j, t in model.pairs)
        z.append(1 / (1 + np.exp(-v)))
    np.testing.assert_allclose(model.score(x[:20]), z)


def test_features_do_not_depend_on_the_block():
    texts = ["one two\none two", "", "a", "x! | y", "été " * 50]
    whole = am.features(next(tb.blocks(pa.array(texts))))
    one = np.concatenate([am.features(next(tb.blocks(pa.array([t])))) for t in texts])
    np.testing.assert_allclose(whole, one)


def test_one_label_or_none(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "b")])
    none = am.learn(docs, spark.createDataFrame([], LABELS), F.lit(True))
    assert [r.score for r in am.score(docs, none).collect()] == [0.5, 0.5]
    ones = am.learn(docs, spark.createDataFrame([(1, 1, 0)], LABELS), F.lit(True))
    assert all(r.score > 0.99 for r in am.score(docs, ones).collect())
    assert am.score(docs_of([]), none).count() == 0
