"""Token counts against the library's own encoding of whole texts, and the cache's life."""
import os
import random

import pytest

from strata.llm import token_counts as tc

TEXTS = ["", None, "Hello  world", "hello world", " HELLO\tworld\n", "a<|endoftext|>b", "A<|ENDOFTEXT|>b <|startoftext|>", "H̱ ẖ T̈",
         "Привет Мир", "日本語テキスト", "it's we'll don't I'M", "x\x0b\x0cy\x85z w v", "1234567890 3.14", "İstanbul ΟΔΟΣ Σ", "a" * 5000,
         "é é ﬁ", "<| a", "\x1c\x1d words", "word " * 3000, "tab\t\ttab", "😀 emoji 👍🏽", "<|endoftext|>" * 3]


def whole(path, texts):
    if path.endswith(".model"):
        import sentencepiece
        own = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(own.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(path)
    return [len(own.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_are_those_of_whole_texts(spark, docs_of, scratch, name):
    path = tc.vocabulary_path(name)
    rnd = random.Random(name)
    alphabet = list("aB. \t\n'sé") + ["́", "<|", "|>", "endoftext", "Σ", " ", "日", "\x1f", "İ"]
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))) for _ in range(400)]
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in tc.count_tokens(docs, f"{scratch}/cache", path).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == whole(path, texts)
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert got[18].over_limit == (got[18].n_tokens > 2048)


def encoded(spark, cache, path):
    return tc.stored_counts(spark, cache, tc.tokenizer_version(path)).count()


def test_only_distinct_misses_are_encoded_and_appended(spark, docs_of, scratch):
    path, cache = tc.vocabulary_path(), f"{scratch}/cache"
    first = docs_of([(1, "one two"), (2, "ONE  two"), (3, "three"), (3, "three"), (None, None)])
    assert sorted(r.n_tokens for r in tc.count_tokens(first, cache).collect()) == [0, 1, 1, 2, 2]
    folder = f"{cache}/tokenizer={tc.tokenizer_version(path)}"
    files = set(os.listdir(folder))
    assert encoded(spark, cache, path) == 3
    # nothing new: no file is written
    assert tc.count_tokens(first, cache).count() == 5
    assert set(os.listdir(folder)) == files
    # a stored count is what is used, as a changed one shows
    version = tc.tokenizer_version(path)
    other = f"{scratch}/other"
    (tc.stored_counts(spark, cache, version).selectExpr("content", "n_tokens + 100 AS n_tokens")
     .write.parquet(f"{other}/tokenizer={version}"))
    second = docs_of([(1, "one TWO"), (4, "four five six")])
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(second, other).collect()}
    assert got == {1: 102, 4: 3} and encoded(spark, other, path) == 4
    # another vocabulary has counts of its own
    tc.count_tokens(first, cache, tc.vocabulary_path("piece_bpe_32k.model")).count()
    assert encoded(spark, cache, path) == 3 and encoded(spark, cache, tc.vocabulary_path("piece_bpe_32k.model")) == 4


def test_rows_appended_twice_are_read_once(spark, docs_of, scratch):
    cache, version = f"{scratch}/cache", tc.tokenizer_version(tc.vocabulary_path())
    docs = docs_of([(1, "one two"), (2, "three")])
    tc.count_tokens(docs, cache).count()
    tc.stored_counts(spark, cache, version).write.mode("append").parquet(f"{cache}/tokenizer={version}")
    assert sorted(r.n_tokens for r in tc.count_tokens(docs, cache).collect()) == [1, 2]


def test_misses_beyond_the_broadcast_threshold(spark, docs_of, scratch):
    texts = [f"words {i} of {i % 7}" for i in range(60)] * 2
    docs = docs_of(list(enumerate(texts)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
    try:
        got = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs, f"{scratch}/cache").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [got[i] for i in range(len(texts))] == whole(tc.vocabulary_path(), texts)


def test_empty_table_extra_columns_and_text_ids(spark, docs_of, scratch):
    assert tc.count_tokens(docs_of([]), f"{scratch}/none").collect() == []
    docs = spark.createDataFrame([("x", "a b", 1, "c")], "doc_id string, text string, n_tokens int, content string")
    assert [(r.doc_id, r.n_tokens) for r in tc.count_tokens(docs, f"{scratch}/cache").collect()] == [("x", 2)]


def test_long_texts_go_in_parts(monkeypatch):
    monkeypatch.setattr(tc, "PART_BYTES", 64)
    monkeypatch.setattr(tc, "WORDS", 32)
    text = " ".join(f"Word{i % 50} x{i}." for i in range(2000)) + "y" * 300
    assert tc.WordCounter(tc.vocabulary_path())(text.encode()) == whole(tc.vocabulary_path(), [text])[0]
