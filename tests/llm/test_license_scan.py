import random
import re

import pytest

from strata.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")


def brute(rows, notices, threshold, phrases=ls.PHRASES):
    known = ls.templates(notices, threshold)
    out = []
    for d, x in rows:
        words = WORD.findall(low(x))
        spots, base = [], set()
        for phrase, label in phrases:
            p = phrase.split(" ")
            found = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
            spots += found
            base |= {label} if found else set()
        own, best = set(), 0.0
        text = re.sub(r"([.!?])[ \t\r]*\n", "\\1\n\n", low(x))
        for block in re.split(r"\n[ \t\r\x0b\x0c]*\n", text):
            have = set(WORD.findall(block))
            for t in known:
                if len(have & t.words) >= t.need:
                    own.add(t.label)
                    best = max(best, len(have & t.words) / len(t.words))
        out.append((str(d), len(words), len(spots), min(spots, default=None), max(spots, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if spots else best))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels),
                    ",".join(r.labels), r.score) for r in df.collect()), key=repr)


def test_real_notices(spark, docs_of):
    rows = [(1, "Foo.\nReleased under the MIT License.\nBar"), (2, "Licensed under CC BY-NC 4.0."),
            (3, "mit license mit license\nMIT  License"), (4, None), (5, ""), (6, "CC BY" * 3),
            (7, "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU\n"
                "General Public License as published by the Free Software Foundation.\n\nThe mit. License"),
            (8, "Gnu General Public License, Éapache License apache license"), (3, "mit license mit license\nMIT  License"),
            (9, "Released under the BSD License"), (10, "this library is free software " * 400 + "\n"), (None, "cc by")]
    got = ls.scan(docs_of(rows).selectExpr("*", "1 AS labels", "2 AS rid", "'x' AS blocks"))
    assert rows_of(got) == brute(rows, ls.TEMPLATES, ls.THRESHOLD)


@pytest.mark.parametrize("seed,threshold", [(1, 0.6), (2, 0.8), (3, 1.0)])
def test_join_finds_every_pair(spark, docs_of, seed, threshold):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(14)] + ["zz", "É"]
    say = lambda n: " ".join(rng.choices(vocab, [16 - i for i in range(16)], k=n))
    notices = [(f"t{i}", say(rng.randint(2, 9))) for i in range(6)]
    rows = [(i, "\n\n".join(say(rng.randint(0, 12)) for _ in range(rng.randint(1, 4)))) for i in range(60)]
    got = ls.scan(docs_of(rows).repartition(3), notices, threshold)
    assert rows_of(got) == brute(rows, notices, threshold)


def test_no_python_and_empty_table(spark, docs_of):
    df = ls.scan(docs_of([]))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)
