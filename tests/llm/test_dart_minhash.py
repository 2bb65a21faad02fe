import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import dart_minhash as dm
from strata.llm import textblocks as tb
from strata.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(x, n=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in x or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def classes_of(ids, edges):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


def brute(rows, threshold):
    sets = {d: shingle_set(x) for d, x in rows}
    ids = sorted(sets)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    return classes_of(ids, edges)


def corpus(seed, groups=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows), rng.choice([" ", ", "]).join(copy)))
    for x in ("", None, "one", "one", "One two", "...", "é a b c d e", "é a b c d e f"):
        rows.append((len(rows), x))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_all_pairs(spark, docs_of, seed):
    rows = corpus(seed)
    got = {r.doc_id: r.class_id for r in dm.near_duplicate_classes(docs_of(rows).repartition(3)).collect()}
    assert got == brute(rows, 0.8)


def test_chain_of_near_copies_in_one_bucket(spark, docs_of):
    # each step changes a little: the ends are far apart, the class is one
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[(i * 7) % 300] = f"n{i}"
    got = {r.doc_id: r.class_id for r in dm.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == brute(rows, 0.8) and set(got.values()) == {0}
    del rng


def test_repeated_rows_nulls_and_firsts(spark, docs_of):
    t = " ".join(f"a{i}" for i in range(60))
    rows = [(5, t), (5, t), (None, t + " z"), (2, t.upper()), (None, None), (7, ""), (7, "")]
    docs = docs_of(rows).selectExpr("*", "'x' AS rid", "1 AS class_id")
    got = sorted((str(r.doc_id), str(r.class_id)) for r in dm.near_duplicate_classes(docs).collect())
    assert got == [("2", "2"), ("5", "2"), ("5", "2"), ("7", "7"), ("7", "7"), ("None", "2"), ("None", "None")]
    kept = dm.first_of_each_class(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "7", "7", "None"]
    assert dm.near_duplicate_classes(docs_of([])).count() == 0


def weighted_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(x, 0), b.get(x, 0)) for x in keys) / sum(max(a.get(x, 0), b.get(x, 0)) for x in keys)


@pytest.mark.parametrize("most", [1, 9])
def test_coordinates_agree_as_the_weighted_similarity(most):
    rng = np.random.default_rng(4)
    k = 128
    for overlap in (0.5, 0.8, 0.95):
        errors = []
        for trial in range(30):
            names = tb.mix(np.arange(200, dtype=np.uint64) + np.uint64(1000 * trial + 1))
            w = rng.integers(1, most + 1, 200)
            a = {n: c for n, c in zip(names.tolist(), w.tolist())}
            b = {n: (c if rng.random() < overlap else max(0, c - int(rng.integers(1, most + 1)))) for n, c in a.items()}
            b = {n: c for n, c in b.items() if c}
            rows = [(0, *p) for p in sorted(a.items())] + [(1, *p) for p in sorted(b.items())]
            r, h, c = (np.array(x) for x in zip(*rows))
            sig = dm.signatures(r, h.astype(np.uint64), c, 2, k)
            errors.append(float((sig[0] == sig[1]).mean()) - weighted_jaccard(a, b))
        assert abs(np.mean(errors)) < 0.025 and np.std(errors) < 0.06


def test_similarities_are_exact():
    rng = random.Random(6)
    xs = [x or "" for _, x in corpus(7, 4)]
    a, b = [rng.choice(xs) for _ in range(50)], [rng.choice(xs) for _ in range(50)]
    got = dm.similarities(pa.array(a), pa.array(b), 5, False)
    for x, y, s in zip(a, b, got):
        p, q = shingle_set(x), shingle_set(y)
        assert s == pytest.approx(len(p & q) / max(1, len(p | q)))


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)]
    edges += [(500, 501 + i) for i in range(50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = classes_of({x for e in edges for x in e}, edges)
    assert {n: c for n, c in want.items() if n != c} == got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_many_copies_that_only_meet_in_their_original(spark, docs_of):
    """Copies that are each close to one text and far from one another are one class."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(400)]
    rows = [(500, " ".join(base))]
    for i in range(120):
        copy = list(base)
        for k in rng.sample(range(0, 400, 8), 7):
            copy[k] = f"x{i}_{k}"
        rows.append((i, " ".join(copy)))
    sets = [shingle_set(x) for _, x in rows]
    far = [len(a & b) / len(a | b) for a, b in zip(sets[1:], sets[2:])]
    assert np.mean(far) < 0.8
    got = {r.doc_id: r.class_id for r in dm.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == brute(rows, 0.8) and len(set(got.values())) == 1


@pytest.mark.parametrize("weighting", ["set", "count"])
def test_near_copies_inside_a_family_of_one_template(spark, docs_of, weighting):
    """Documents of one template are all just under the threshold; the one pair above it is in no bucket's centre."""
    template = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join(template + [f"d{i}x{k}" for k in range(36 if i in (40, 60) else 40)])) for i in range(120)]
    want = brute(rows, 0.8)
    assert [d for d, c in want.items() if d != c] == [60] and want[60] == 40
    got = {r.doc_id: r.class_id for r in dm.near_duplicate_classes(docs_of(rows), weighting=weighting).collect()}
    assert got == want


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_filters_of_the_exact_join_leave_no_pair_out(spark, docs_of, threshold):
    rows = [(d, x) for d, x in corpus(21, 8) if x and shingle_set(x)]
    sets = {d: shingle_set(x) for d, x in rows}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}
    import zstandard
    texts = spark.createDataFrame([(d, zstandard.compress(x.encode())) for d, x in rows], "node long, z binary")
    label = texts.select("node", texts.node.alias("label"))
    pairs = {(r.a, r.b) for r in dm._close_pairs(texts, label, 5, threshold, False).collect()}
    assert want <= pairs and len(want) > 0


def _peak(work):
    """MB that ``work`` holds at most at a time, beyond what was there."""
    import tracemalloc
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_does_not_follow_the_number_of_short_rows():
    import numpy as np
    import pyarrow as pa

    from strata.llm import dart_minhash as dm
    from strata.llm import textblocks as tb
    texts = pa.array([" ".join(f"w{(i * 7 + k) % 5000}" for k in range(12)) for i in range(8192)])
    block = next(tb.blocks(texts))
    row, name, _ = dm.shingles(block)
    weight = np.ones(len(row))
    found = []
    assert _peak(lambda: found.append(dm.signatures(row, name, weight, block.n))) < 300
    for i in (0, 1023, 1024, 5000, 8191):                  # whatever rows throw beside it
        own = row == i
        assert np.array_equal(found[0][i], dm.signatures(row[own] - i, name[own], weight[own], 1)[0])


def test_memory_of_pairs_of_long_texts():
    import pyarrow as pa
    import zstandard

    from strata.llm import dart_minhash as dm
    long = [zstandard.compress(" ".join(f"w{i}x{k}" for k in range(8000)).encode()) for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(96)), pa.array([long[i % 8] for i in range(96)]), pa.array([long[i % 7] for i in range(96)])],
                                       ["p", "za", "zb"])
    sizes = []

    def work():
        for lo, (a, b) in dm._pairs_of_texts(batch):
            sizes.append(len(a))
            dm.similarities(a, b, 5, False)
    assert _peak(work) < 250 and sum(sizes) == 96 and max(sizes) < 40
    got = [r for part in dm._checked(5, 0.8, False)(iter([batch])) for r in part.column("p").to_pylist()]
    assert got == [i for i in range(96) if i % 8 == i % 7]


def test_few_pairs_of_a_template_family_reach_the_texts(spark, docs_of, monkeypatch):
    """14 slots of 50 values between fixed words, similarity near 0.7: hardly a pair is compared on its texts."""
    import random

    from strata.llm import dart_minhash as dm
    rnd = random.Random(8)
    rows = []
    for i in range(300):
        parts = []
        for s in range(14):
            parts += [f"slot{s}v{rnd.randint(0, 49)}"] + [f"t{s}w{k}" for k in range(27)]
        rows.append((i, " ".join(parts)))
    seen = []
    own = dm._sharing_enough

    def counted(pairs, entries, threshold):
        out = own(pairs, entries, threshold)
        seen.append((pairs.count(), out.count()))
        return out
    monkeypatch.setattr(dm, "_sharing_enough", counted)
    got = {r.doc_id: r.class_id for r in dm.near_duplicate_classes(docs_of(rows)).collect()}
    sets = [frozenset(zip(*(t.split()[j:] for j in range(5)))) for _, t in rows]
    near = [(i, j) for i in range(300) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = list(range(300))
    for _ in range(300):
        for i, j in near:
            want[i] = want[j] = min(want[i], want[j])
    assert [got[i] for i in range(300)] == want
    assert seen and seen[0][1] <= max(300, len(near) * 4)


def test_rounds_that_settle_little_give_way_to_the_exact_join(spark, docs_of, monkeypatch):
    """Documents of one template, most in one pair: each centre finds its own partner, and the buckets stay as they are."""
    template = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join(template + [f"p{i // 2}x{k}" for k in range(20 if i < 160 else 0)]
                         + [f"d{i}x{k}" for k in range(20 if i < 160 else 40)])) for i in range(200)]
    want = brute(rows, 0.8)
    assert sum(d != c for d, c in want.items()) == 80
    checks, plans, own, written = [], [], dm._checked, dm.stage
    monkeypatch.setattr(dm, "_checked", lambda *a: checks.append(a) or own(*a))
    monkeypatch.setattr(dm, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df, name))
    got = {r.doc_id: r.class_id for r in dm.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == want
    assert len(checks) <= 3  # at most two rounds and the exact join
    # what is left of the buckets is written once a round, not joined anew by all that read it
    assert not [p for p in plans if "LeftAnti" in p] and max(p.count("Join ") for p in plans) <= 7
