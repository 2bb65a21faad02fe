"""Alignment against whole texts tokenised one by one and links counted in plain Python."""
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from strata.llm import token_alignment as ta

TEXTS = ["", None, "Hello world", " leading", "trailing  ", "two  spaces   here", "a▁b", "line one.\nline two\r\n three", "it's don't", "日本語 テキスト",
         "Привет, мир", "<|endoftext|> plain <s>", "  x   y", "\t tab \x0b vt", " ", "   ", "x\x00y", "é é", "😀👍🏽 ok", "naïve café " * 40,
         "<0x41> <unk>", "a 　 b   c", "word\x1c next", "Hello world", "Hello world"]


def plainly(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path(ta.VOCABULARY_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(ta.VOCABULARY_B))
    voc = ta.Pair.of(public_tokenizers.path(ta.VOCABULARY_A), public_tokenizers.path(ta.VOCABULARY_B))
    aligned, total, docs_of = [], Counter(), Counter()
    for t in texts:
        if not t:
            aligned.append(None)
            continue
        x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        xs, ys = [voc.a_bytes[i] for i in x], [voc.b_bytes[i] for i in y]
        if not b"".join(xs) == b"".join(ys) == (" " + t).encode():
            aligned.append(None)
            continue
        xe, ye = np.cumsum([len(s) for s in xs]).tolist(), np.cumsum([len(s) for s in ys]).tolist()
        links = [(x[i], y[j]) for i in range(len(x)) for j in range(len(y))
                 if max(xe[i] - len(xs[i]), ye[j] - len(ys[j])) < min(xe[i], ye[j])]
        cuts = sorted(set(xe) & set(ye))
        groups = []
        for lo, hi in zip([0] + cuts, cuts):
            groups.append(",".join(str(i) for i, e in zip(x, xe) if lo < e <= hi) + "|" + ",".join(str(j) for j, e in zip(y, ye) if lo < e <= hi))
        total.update(links)
        docs_of.update(set(links))
        aligned.append((len(x), len(y), groups, links))
    most = {}
    for (p, q), n in total.items():
        most[q] = max(most.get(q, 0), n)
    rows = []
    for v in aligned:
        if v is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups, links = v
        rows.append((na, nb, len(groups), len(links), sum(total[k] == most[k[1]] for k in links), sum(total[k] for k in links),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows, {(p, q): (docs_of[p, q], n, n == most[q]) for (p, q), n in total.items()}


def some_texts(seed, n):
    rnd = random.Random(seed)
    alphabet = list("abe Aé. \n") + [" ", "  ", "the", " of", " ", "日本", "Слово", "'s", "123", "\t", " ", "\r"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [ta.CHUNK_BYTES, 2000])
def test_against_whole_texts(spark, docs_of, monkeypatch, chunk):
    monkeypatch.setattr(ta, "CHUNK_BYTES", chunk)      # the session's workers are forked: the closure carries _index only
    texts = TEXTS + some_texts(1, 300) + ["the the the of of " * 20] * 30
    docs = docs_of(list(enumerate(texts)))
    found = ta.align(docs)
    rows, pairs = plainly(texts)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found.documents.collect()}
    assert [got[i] for i in range(len(texts))] == rows
    assert {(r.a, r.b): (r.documents, r.links, r.is_best) for r in found.pairs.collect()} == pairs


def test_segments_rejoin_and_are_independent():
    for t in [x for x in TEXTS if x] + some_texts(2, 300):
        if t:
            assert b"".join(ta.segments(b" " + t.encode())) == b" " + t.encode()


def test_bitmaps_give_their_members_back():
    rnd = np.random.default_rng(3)
    for span in (1, 7, 100, 5000):
        sets = [np.sort(rnd.choice(span, rnd.integers(1, span + 1), replace=False)) for _ in range(40)] + [np.arange(span)]
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        maps = ta.bitmaps(row, np.concatenate(sets), len(sets), span)
        assert max(len(x.as_py()) for x in maps) <= (span + 7) // 8
        r, m = ta.members(maps.slice(3), span)
        for k in range(3, len(sets)):
            assert np.array_equal(np.sort(m[r == k - 3]), sets[k])
    assert isinstance(maps, pa.Array)


def test_empty_table_repeats_extra_columns_and_text_ids(spark, docs_of):
    assert ta.align(docs_of([])).documents.collect() == []
    docs = spark.createDataFrame([("x", "Hello there", 1, b"q"), ("x", "Hello there", 2, b"r"), (None, None, 3, b"")],
                                 "doc_id string, text string, chunk int, docs binary")
    got = sorted(ta.align(docs).documents.collect(), key=lambda r: r.n_a)
    assert [r.doc_id for r in got] == [None, "x", "x"] and got[1] == got[2] and got[1].count_sum == 2 * got[1].n_links


def test_one_long_text(spark, docs_of):
    text = " ".join(f"word{i % 900} of it" for i in range(60000))
    rows, _ = plainly([text[:20000]])
    whole = ta.align(docs_of([(1, text[:20000])])).documents.first()
    assert tuple(whole)[1:] == rows[0]
    assert ta.align(docs_of([(1, text), (2, "it")])).documents.count() == 2
