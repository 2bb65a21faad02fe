import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import language_net as ln
from strata.llm import textblocks as tb

SYLLABLES = {"en": ["the", "ing", "and", "th"], "de": ["sch", "ung", "ß", "ein"], "fr": ["eau", "é", "que", "ou"]}


def say(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def corpus(seed, n=240):
    rng = random.Random(seed)
    return [(i, say(rng, lang, rng.randint(3, 120)), lang, "s") for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]


def test_held_out_accuracy_and_defined_cases(spark, docs_of):
    rows = corpus(1) + [(900, None, "en", "s"), (901, "", "en", "s"), (902, "12 34 --", "de", "s"), (903, "the", None, "s"),
                        (904, "sch ung " * 5000, "de", "s"), (3, "the ing", "en", "s"), (3, "the ing", "en", "s")]
    docs = docs_of(rows).repartition(3).selectExpr("*", "1 AS rid", "'x' AS lang_pred", "2 AS score")
    held = F.col("doc_id") % 3 == 1
    net = ln.learn(docs, ~held, per_language=80, steps=120)
    got = {r.doc_id: r for r in ln.predict(docs, net).collect()}
    assert ln.predict(docs, net).count() == len(rows)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    held_rows = [r for r in rows if r[0] % 3 == 1 and r[0] < 900]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held_rows]) > 0.95
    assert got[904].lang_pred == "de" and all(0 <= r.score <= 1 for r in got.values())


def test_scoring_tables_equal_the_network():
    rng = np.random.default_rng(2)
    net = ln.Net(["a", "b", "c"])
    x = rng.integers(0, 256, (7, ln.WINDOW)).astype(np.uint8)
    pooled, _ = net.pooled(x)
    z = np.maximum(pooled, 0) @ net.out + net.base
    want = np.log(ln._softmax(z))
    np.testing.assert_allclose(net.log_probabilities(x, net.tables()), want, rtol=1e-3, atol=1e-4)


def test_gradient_points_downhill():
    rng = np.random.default_rng(3)
    net = ln.Net(["a", "b"])
    x = rng.integers(97, 122, (64, ln.WINDOW)).astype(np.uint8)
    y = (x[:, 0] > 108).astype(int)
    x[y == 1, 5:9] = np.frombuffer(b"zzzz", np.uint8)
    adam = [(np.zeros_like(a), np.zeros_like(a)) for a in net.parameters()]
    losses = [net.step(x, y, adam, t, 0.02) for t in range(1, 40)]
    assert losses[-1] < 0.2 * losses[0]


def test_windows_cover_every_byte():
    texts = ["a" * 300, "", "é" * 64, "xyz"]
    block = next(tb.blocks(pa.array(texts)))
    x, row = ln.windows(block)
    for i, t in enumerate(texts):
        assert b"".join(w.tobytes() for w in x[row == i]).rstrip(b"\0") == t.encode()


def test_nothing_to_learn(spark, docs_of):
    docs = docs_of([(1, "abc", None, "s")])
    assert ln.learn(docs, F.lit(True)) is None
    assert [(r.lang_pred, r.score) for r in ln.predict(docs, None).collect()] == [("und", 0.0)]
    assert ln.predict(docs_of([]), None).count() == 0


def test_every_language_is_learned_however_many(spark, docs_of):
    docs = docs_of([(i, f"word{chr(97 + i % 26)} and more", f"l{i}", "s") for i in range(ln.LANGUAGES + 20)])
    net = ln.learn(docs, F.lit(True), steps=1)
    assert sorted(net.languages) == sorted(f"l{i}" for i in range(ln.LANGUAGES + 20))
