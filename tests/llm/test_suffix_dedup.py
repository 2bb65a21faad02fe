import hashlib
import random

import pyarrow as pa
import pytest

from strata.llm import suffix_dedup as sd
from strata.llm import textblocks as tb


def brute(rows, t):
    """(n_bytes, n_removed, n_spans, digest) of each row, by the definition."""
    first = {}
    texts = [(-(1 << 63) if d is None else d, (x or "").encode()) for d, x in rows]
    for d, x in texts:
        for s in range(len(x) - t + 1):
            w = x[s:s + t]
            first[w] = min(first.get(w, (d, s)), (d, s))
    out = []
    for d, x in texts:
        gone = [False] * len(x)
        for s in range(len(x) - t + 1):
            if first[x[s:s + t]] < (d, s):
                gone[s:s + t] = [True] * t
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(c for c, g in zip(x, gone) if not g)
        out.append((len(x), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def noise(rng, n, alphabet="abcdefgh éß\n"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    shared = [noise(rng, rng.randint(15, 120)) for _ in range(4)]
    rows = [(i, "".join(noise(rng, rng.randint(0, 40)) + rng.choice(shared) for _ in range(rng.randint(0, 4)))
             + noise(rng, rng.randint(0, 30))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(6)]           # copies
    rows += [(3, rows[3][1]), (None, rows[5][1]), (None, shared[0]), (3, shared[1] + "x" + rows[3][1])]
    rows += [(200, "ab" * 90), (201, "ab" * 40 + "c" + "ab" * 40), (202, ""), (203, None), (204, "é" * 50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,group_rows", [(1, 20_000), (2, 2), (3, 1)])
def test_against_definition(spark, docs_of, seed, group_rows, monkeypatch):
    rows = corpus(seed)
    got = sd.remaining(docs_of(rows).repartition(5), digest=True, threshold=20, gram=8, group_rows=group_rows)
    have = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.left) for r in got.collect())
    want = sorted((str(d), *b) for (d, _), b in zip(rows, brute(rows, 20)))
    assert have == want


def test_rerank_over_tiny_batches():
    rng = random.Random(5)
    pairs = sorted({(rng.randint(0, 6), rng.randint(0, 3), rng.randint(0, 3), rng.randint(0, 5), 1)
                    for _ in range(120)})

    def run(size):
        cols = [[p[0] for p in pairs], [p[1] for p in pairs], [p[4] for p in pairs], [p[2] for p in pairs],
                [p[3] for p in pairs], [1] * len(pairs)]
        whole = sd._table(sd._PAIRS, cols)
        parts = [whole.slice(i, size) for i in range(0, len(pairs), size)]
        return sorted(tuple(r.values()) for b in sd._rerank(10)(iter(parts)) for r in b.to_pylist())

    assert run(1) == run(2) == run(7) == run(1000)


def test_long_text_in_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tb, "BLOCK_BYTES", 64)
    rng = random.Random(9)
    part = noise(rng, 150)
    texts = [noise(rng, 300) + part + noise(rng, 200) + part, part + noise(rng, 90), noise(rng, 500)]
    out = []
    for block, skipped in sd._chunks(pa.array(texts), 20):
        row, lo, n, _, _ = sd._sample(block, 20, 8)
        out += [(block.lo + r, a + skipped + i) for r, a, k in zip(row, lo - block.starts[row], n) for i in range(k)]
    assert sorted(out) == [(r, s) for r, x in enumerate(texts) for s in range(len(x.encode()) - 19)]


def test_empty_table_and_text_result(spark, docs_of):
    assert sd.remaining(docs_of([]), threshold=20, gram=8).count() == 0
    a = "0123456789abcdefghijklmnop"
    got = sd.remaining(docs_of([(1, a), (2, "é" + a + "é")]), threshold=20, gram=8).collect()
    assert {r.doc_id: r.left for r in got} == {1: a, 2: "éé"}
