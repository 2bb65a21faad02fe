"""The driver queries of the training-data operators, and their SQL twins.

Each query applies its operator, with production parameters, to its whole table
and derives the digest columns of its contract from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (additive_model, conversation_repair, dart_minhash, decontaminate, fertility, fixity, language_net,
                        license_scan, mixing, suffix_dedup, token_alignment, token_counts, toxicity)
from strata.llm.tables import table
from strata.session import scratch_path

SURE = 0.7


def _fold(n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(-1))


def _predicted(scored: DataFrame, held: Column) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= SURE).cast("int").alias("predicted"))


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op2_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return fixity.audit(pages, fixity.damaged(pages))


def op3_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), _fold(4) == 2
    model = additive_model.learn(docs, table(spark, sf_dir, "labels"), ~held)
    return _predicted(additive_model.score(docs, model), held)


def op4_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.select_documents(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op6_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), _fold(3) == 1
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held)
    return _predicted(toxicity.score(docs, model), held)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix_dedup.remaining(table(spark, sf_dir, "documents"), digest=True)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("left").alias("kept_sha256")))


def op8_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), _fold(3) == 1
    found = language_net.predict(docs, language_net.learn(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents")).documents


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache begins empty, so that the result and the work depend on the table alone."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {f.__name__: f for f in (
    op1_dart_minhash, op2_fixity_audit, op3_additive_quality, op4_hierarchical_mix, op5_license_scan,
    op6_compression_toxicity, op7_suffix_dedup, op8_token_fertility, op9_decontaminate, op10_byte_language,
    op11_token_alignment, op12_conversation_repair, op13_token_counts)}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_DECONTAMINATE = f"""
WITH low AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    '{license_scan.UPPER}', '{license_scan.LOWER}'), '{_WORD}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'),
    '{_WORD}') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS x FROM (
  SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS x FROM (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM low, sizes WHERE len(w) >= k)),
found AS (SELECT r, s, k, item_id FROM places JOIN windows USING (k, x)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT r, s, k FROM found))
  GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM low LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

ORACLE_SQL = {
    "op2_fixity_audit": fixity.oracle_sql(),
    "op4_hierarchical_mix": mixing.oracle_sql(),
    "op5_license_scan": license_scan.oracle_sql(),
    "op9_decontaminate": _DECONTAMINATE,
}
