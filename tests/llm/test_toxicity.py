import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import toxicity as tx

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(600)]
    insults = ["vilething", "badword", "nasty"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(3, 200))
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(insults + ["stem" + rng.choice("xyzuvw") * 2]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_defined_cases(spark, docs_of):
    rows, labels = corpus(1)
    rows += [(900, None), (901, ""), (902, "-- !!"), (5, rows[5][1]), (None, "a badword b"), (903, "word " * 20_000 + "badword")]
    labels += [(7, 1, 0), (7, 1, 1), (None, 1, 1), (8, None, None)]
    docs = docs_of(rows).repartition(3).selectExpr("*", "1 AS score", "2 AS label", "'x' AS rid", "3 AS distance")
    held = F.col("doc_id") % 3 == 1
    model = tx.learn(docs, spark.createDataFrame(labels, LABELS), ~held)
    got = tx.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[900].distance == by[901].distance == by[902].distance == 0
    assert by[900].score == by[901].score <= by[903].score and by[903].at_word == 20_000 // tx.WINDOW * tx.WINDOW
    truth = {d: t for d, _, t in labels[:400]}
    hits = [(by[d].score >= 0.7, truth[d]) for d in range(400) if d % 3 == 1]
    assert np.mean([a == b for a, b in hits]) > 0.95


def test_calibration_rises():
    at, value = tx._isotonic(np.array([0, 0, 1, 2, 2, 3, 9.0]), np.array([0, 1, 0, 0, 1, 1, 1.0]))
    assert (np.diff(value) >= 0).all() and (np.diff(at) > 0).all() and value[0] < 0.5 < value[-1]


def test_one_label_or_none(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "b")])
    none = tx.learn(docs, spark.createDataFrame([], LABELS), F.lit(True))
    assert [r.score for r in tx.score(docs, none).collect()] == [0.0, 0.0]
    ones = tx.learn(docs, spark.createDataFrame([(1, 1, 1)], LABELS), F.lit(True))
    assert [r.score for r in tx.score(docs, ones).collect()] == [1.0, 1.0]
    assert tx.score(docs_of([]), none).count() == 0


def test_distances_are_those_of_plain_compression():
    """Window lengths under either dictionary, compressed one by one with a fresh compressor."""
    import zstandard
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 32, (400, len(tx.STEMS) + 1), dtype=np.uint32)
    ordinary = words[:200].tobytes()
    toxic = ordinary + words[200:260].tobytes()
    text = words[rng.integers(0, 400, 150)]
    step = tx.WINDOW
    want = []
    for lo in range(0, len(text), step):
        size = []
        for content in (ordinary, toxic):
            p = zstandard.ZstdCompressionParameters.from_level(tx.LEVEL, min_match=4, write_content_size=False,
                                                               write_checksum=False, write_dict_id=False)
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            size.append(len(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress(text[lo:lo + step].tobytes())))
        want.append(size[0] - size[1])
    got = tx.Compressors(ordinary, toxic).distances(text)
    assert len(got) == len(want) and all(abs(a - b) <= 2 for a, b in zip(got, want)) and max(got) > 16
