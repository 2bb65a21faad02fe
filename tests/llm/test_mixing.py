import hashlib
import random
import re
from collections import defaultdict

import pytest

from strata.llm import mixing as mx


def fill(budget, children):
    """children: (name, weight, limit) -> shares, filled up to limits in order of limit by weight."""
    out, left, heavy = {}, budget, sum(w for _, w, _ in children)
    order = sorted(children, key=lambda c: (c[2] / max(c[1], 1), c[0]))
    for k, (name, w, limit) in enumerate(order):
        if limit * heavy <= left * w:
            out[name], left, heavy = limit, left - limit, heavy - w
        else:
            for n, v, _ in order[k:]:
                out[n] = left * v // heavy
            break
    return out


def brute(rows, weights, share, epochs, seed):
    leaf = defaultdict(lambda: defaultdict(lambda: [None, 0, 0]))
    for d, x, lang, source in rows:
        source, lang, x = source or "unknown", lang or "unknown", x or ""
        digits = re.search(r"(\d{1,9})$", source)
        domain = f"domain{int(digits[1]) % 4 if digits else 0}"
        key = str(d) if d is not None else "text:" + hashlib.md5(x.encode()).hexdigest()
        e = leaf[domain, lang, source][key]
        e[0], e[1], e[2] = d, e[1] + 1, e[2] + len(re.findall(mx.TOKEN, x))
    supply = {k: sum(e[2] for e in v.values()) for k, v in leaf.items()}
    total = sum(supply.values()) * share[0] // share[1]
    w = lambda level, name: weights.get(level, {}).get(name, 1)

    def down(path, budget):
        if len(path) == 3:
            return {path: budget}
        names = sorted({k[len(path)] for k in supply if k[:len(path)] == path})
        children = [(n, w(mx.LEVELS[len(path)], n),
                     epochs * sum(s for k, s in supply.items() if k[:len(path) + 1] == path + (n,))
                     if w(mx.LEVELS[len(path)], n) else 0) for n in names]
        out = {}
        for n, b in fill(budget, children).items():
            out.update(down(path + (n,), b))
        return out

    out = []
    for k, budget in down((), total).items():
        if not supply[k] or not budget:
            continue
        full, rest, run = budget // supply[k], budget % supply[k], 0
        for key, (d, n, t) in sorted(leaf[k].items(), key=lambda e: (
                hashlib.md5(f"{seed}:{full}:{e[0]}".encode()).hexdigest(), e[0])):
            run += t
            if full + (run <= rest):
                out.append((str(d), *k, n, t, full + (run <= rest)))
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 40]))), rng.choice(["en", "en", "de", None]),
             rng.choice(["src0"] * 5 + ["src1", "src2", "src5", "other", None])) for i in range(n)]
    return rows + [(3, "a b", "en", "src0"), rows[4], rows[4], (None, "a b c", "en", "src0"), (None, "a b c", "en", "src0"),
                   (None, None, "en", "src0")]


@pytest.mark.parametrize("seed,share,bucket_rows", [(1, (1, 2), 4096), (2, (1, 2), 4), (3, (2, 1), 1), (4, (5, 1), 4)])
def test_against_definition(spark, docs_of, seed, share, bucket_rows):
    rows = corpus(seed)
    weights = {"domain": {"domain0": 3, "domain2": 0}, "lang": {"en": 5}, "source": {"src5": 2}}
    got = mx.select_documents(docs_of(rows), weights=weights, share=share, max_epochs=2, seed=7, bucket_rows=bucket_rows)
    have = sorted((str(r.doc_id), r.domain, r.lang, r.source, r.n_rows, r.n_tokens, r.copies) for r in got.collect())
    assert have == brute(rows, weights, share, 2, 7)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "en", "s1", 1, 10), ("a", "en", "s2", 1, 1000), ("b", "en", "s3", 1, 1000)],
                                   "domain string, lang string, source string, n_docs long, supply long")
    got = {r.source: r.budget for r in mx.budgets(leaves, {}, (1, 5), 1).collect()}
    assert got == {"s1": 10, "s2": 191, "s3": 201}


def test_empty_table_and_native_plan(spark, docs_of):
    df = mx.select_documents(docs_of([]).selectExpr("*", "1 AS key", "2 AS budget"))
    assert df.count() == 0
    assert not re.search("Python|Arrow|Pandas|Cartesian", df._jdf.queryExecution().executedPlan().toString())
    with pytest.raises(ValueError):
        mx.select_documents(docs_of([(1, "a")]), weights={"lang": {"en": -1}}).count()
