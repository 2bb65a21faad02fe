import os
import random
import re

import pytest

from strata.llm import fertility as fe
from strata.llm import textblocks as tb
from strata.llm.textstats import Words

pytestmark = pytest.mark.skipif(not os.path.isdir(fe.VOCABULARIES), reason="no vocabularies on this machine")


def brute(x):
    x = x or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", x)
    seen, dup = set(), 0
    for line in x.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    win = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {j for i, w in enumerate(win) if win.count(w) > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(again), failed


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["a", "the", "é", "xx#", "|", "日本語", "word", "K\u00a0x", "\x1f"]
    rows = []
    for i in range(40):
        lines = [" ".join(rng.choices(vocab, k=rng.randint(0, 9))) for _ in range(rng.randint(0, 14))]
        rows.append((i, rng.choice(["\n", "\r\n", " \n\n"]).join(lines + lines[:rng.randint(0, 2)])))
    return rows + [(50, None), (51, ""), (52, "one two\none two"), (52, "x " * 300), (53, "\n\n"), (None, "w" * 5000), (3, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_base_figures(spark, docs_of, seed):
    rows = corpus(seed)
    got = fe.judge(docs_of(rows).repartition(3).selectExpr("*", "1 AS n_words", "2 AS kept")).collect()
    have = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in got)
    assert have == sorted((str(d), *brute(x)) for d, x in rows)
    assert all(not r.kept for r in got if r.base_failed)


def test_words_one_by_one_equal_the_whole_text():
    import pyarrow as pa
    voc = fe.Vocabularies.of(fe.VOCABULARIES)
    texts = ["The quick brown fox été 日本 \u2603 jumps", "a a a b", "", "x" * 300]
    for _ in range(2):  # the second time from the cache
        block = next(tb.blocks(pa.array(texts)))
        pieces, bpe, fallback, entropy = fe._tokens(Words(block), voc)
        whole = [voc.pieces.encode(t) for t in texts[:3]]
        assert pieces.tolist()[:3] == [len(w) for w in whole]
        assert fallback.tolist()[:3] == [sum(voc.pieces.is_byte(i) for i in w) for w in whole]
        assert entropy[1] == pytest.approx(0.8112781) and entropy[2] == 0


def test_long_words_are_tokenised_whole():
    import pyarrow as pa
    voc = fe.Vocabularies.of(fe.VOCABULARIES)
    texts = ["日本語の研究所と東京大学" * 40, "ที่อยู่อาศัยของคนไทย" * 30, "xé" * 700]
    pieces, bpe, fallback, _ = fe._tokens(Words(next(tb.blocks(pa.array(texts)))), voc)
    whole = [voc.pieces.encode(t) for t in texts]
    assert pieces.tolist() == [len(w) for w in whole]
    assert bpe.tolist() == [len(voc.bpe.encode_ordinary(" " + t)) for t in texts]
    assert fallback.tolist() == [sum(voc.pieces.is_byte(i) for i in w) for w in whole]


def test_bands_reject_what_stands_out(spark, docs_of):
    rng = random.Random(4)
    common = ["water", "house", "river", "stone", "light", "night", "bread", "world", "green", "small", "every", "again"]
    rows = [(i, " ".join(rng.choices(common, k=100) + [f"{i} {k}" for k in range(20)]), "en", "s") for i in range(150)]
    rows += [(900, " ".join(f"%%q{i}#z&&" for i in range(120)), "en", "s"), (901, "\u2603\u2604 " * 3 + " ".join(
        chr(0x2600 + i % 200) * 3 + str(i) for i in range(120)), "en", "s")]
    got = {r.doc_id: r for r in fe.judge(docs_of(rows)).collect()}
    assert not got[900].kept and not got[901].kept and "fallback" in got[901].outside
    assert sum(r.kept for i, r in got.items() if i < 900) >= 148


def test_empty_table(spark, docs_of):
    assert fe.judge(docs_of([])).count() == 0
