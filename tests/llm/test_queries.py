"""The registered queries on the smallest test tables, against their SQL twins and plain Python."""
import hashlib
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from strata.llm import queries, stages  # noqa: E402
from strata.llm.tables import table  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    have = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert have == sorted((tuple(map(plain, r)) for r in found), key=repr)


def test_contract_columns(spark):
    want = {
        "op3": {"doc_id", "held_out", "score", "predicted"}, "op6": {"doc_id", "held_out", "score", "predicted"},
        "op5": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
        "op7": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        "op8": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op9": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
        "op10": {"doc_id", "held_out", "lang_pred", "score"},
    }
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    for name in ("op3_additive_quality", "op8_token_fertility", "op10_byte_language"):
        df = queries.QUERIES[name](spark, SF)
        assert want[name.split("_")[0]] <= set(df.columns)
        assert df.count() == table(spark, SF, "documents").count()


def test_pipeline_stages_chain(spark):
    docs = table(spark, SF, "documents")
    now = docs
    counts = []
    for name, apply in corpus_pipeline.STAGES[:-1]:
        now = apply(spark, now, SF)
        assert now.columns == docs.columns, name
        now = spark.createDataFrame(now.collect(), docs.schema)
        counts.append(now.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    ids = {r.doc_id for r in now.collect()}
    assert {r.doc_id for r in last.collect()} <= ids


def test_pipeline_against_its_stages_by_hand(spark):
    """Near copies, repeats and benchmark passages planted in a small table, followed by hand."""
    from pyspark.sql import functions as F
    base = [" ".join(hashlib.md5(f"{i}.{k}".encode()).hexdigest()[:6] for k in range(80)) for i in range(6)]
    shared = " ".join(f"shared{k}" for k in range(30))
    bench = " ".join(r.text for r in table(spark, SF, "benchmark").limit(1).collect())
    rows = [(1, base[0]), (2, base[0]), (3, base[0] + " tail"), (4, base[1] + " " + shared), (5, base[2] + " " + shared),
            (6, base[3] + " " + bench), (7, base[4]), (8, None), (9, "")]
    docs = spark.createDataFrame([(d, x, "en", "src0", len(x or "")) for d, x in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    near = stages.near_dedup_stage(spark, docs, SF)
    assert sorted(r.doc_id for r in near.collect()) == [1, 4, 5, 6, 7, 8, 9]
    cut = stages.suffix_dedup_stage(spark, near, SF)
    left = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert left[5] == (base[2], len(base[2])) and left[4][0] == base[1] + " " + shared and left[8] == (None, 0)
    clean = stages.decontaminate_stage(spark, cut, SF)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 4, 5, 7, 8, 9]
    mix = stages.mixing_stage(spark, clean, SF).agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0]
    total = sum(len((t or "").split()) for t, _ in (left[d] for d in (1, 4, 5, 7)))
    assert 0 < mix <= total // 2


#: names that operators and stages use inside, and those they used to
INTERNAL = ["row_key", "known_lang", "rest", "every", "n", "rid", "doc", "node", "label", "z", "spans", "band", "octave", "class_key",
            "_rid", "__row_key", "__lang", "__left", "__all", "__key", "__n", "content", "chunk", "pair", "key", "left"]


def test_stages_with_internal_names_as_columns_and_text_ids(spark):
    base = [" ".join(hashlib.md5(f"{i}.{k}".encode()).hexdigest()[:6] for k in range(80)) for i in range(4)]
    rows = [(f"id{i}", t, "en", "src0", len(t or ""), *(f"{c}{i}" for c in INTERNAL))
            for i, t in enumerate([base[0], base[0], base[1], base[2] + " " + base[1], None, ""])]
    kinds = "doc_id string, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    docs = spark.createDataFrame(rows, kinds)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        if name == "suffix_dedup":            # goes by the order of whole-number ids
            own = docs.withColumn("doc_id", docs.doc_id.substr(3, 9).cast("long"))
        else:
            own = docs
        out = apply(spark, own, SF)
        assert out.columns == docs.columns, name
        for r in out.collect():
            i = int(str(r["doc_id"]).removeprefix("id"))
            assert [r[c] for c in INTERNAL] == [f"{c}{i}" for c in INTERNAL], name


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, SF).count() == 0
