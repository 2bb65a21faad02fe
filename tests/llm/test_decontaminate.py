import random
import re

import pytest

from strata.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(x):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in x or ""))


def brute(docs, items, window):
    out = []
    for d, x in docs:
        w = words(x)
        hit, ids = set(), set()
        for i, t in items:
            v = words(t)
            k = min(window, len(v))
            if not k:
                continue
            tests = {tuple(v[s:s + k]) for s in range(len(v) - k + 1)}
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in tests:
                    hit.update(range(p, p + k))
                    if i is not None:
                        ids.add(str(i))
        out.append((str(d), len(w), len(hit), sorted(ids)))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "É", "é", "c2", "dd", "K"]
    say = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.randint(0, 9))) for i in range(25)] + [(7, say(6)), (None, say(5)), (30, None), (31, "zz")]
    docs = [(i, say(rng.randint(0, 40))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "zz"), (3, docs[3][1]), (None, items[2][1]), (53, "... --")]
    return docs, items


@pytest.mark.parametrize("seed,block_words", [(1, 200_000), (2, 40)])
def test_against_definition(spark, docs_of, seed, block_words):
    docs, items = corpus(seed)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.find_matches(docs_of(docs).repartition(3), bench, window=4, lead=2, block_words=block_words).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(r["items"])) for r in got) == brute(docs, items, 4)


def test_longest_matches(spark, docs_of):
    bench = spark.createDataFrame([(1, "p q r s t u v"), (2, "x y")], "item_id long, text string")
    got = dc.find_matches(docs_of([(9, "k Q R S t u n x y x y")]), bench, window=3, lead=2).collect()[0]
    assert [tuple(m) for m in sorted(got.matches)] == [("1", 1, 1, 5), ("2", 0, 7, 2), ("2", 0, 9, 2)]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.find_matches(docs_of([]), some).count() == 0
    rows = dc.find_matches(docs_of([(1, "a b c")]), none).collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in rows] == [(3, 0, [])]


def test_clean_documents_keep_their_columns(spark, docs_of):
    docs = docs_of([(1, "u a b c d v"), (2, "w"), (2, None)]).selectExpr("*", "1 AS rid", "'x' AS items")
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    got = dc.clean_documents(docs, bench, window=4)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.text) == [(2, "w")] and got.count() == 2
