"""The pipeline's stages: each takes (spark, docs, sf_dir) and returns documents.

Each works on whatever its predecessor kept. All but the last return the columns
of the documents they were given; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import dart_minhash, decontaminate, fertility, mixing, suffix_dedup
from strata.llm.tables import fresh_names, row_key, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    key, lang = fresh_names(docs, "row_key", "known_lang")
    kept = fertility.judge(docs).filter("kept").select(F.col("rid").alias(key), F.col("lang").alias(lang)).distinct()
    return (docs.withColumn(key, row_key()).withColumn(lang, F.coalesce(F.col("lang"), F.lit("unknown")))
            .join(kept, [key, lang], "left_semi").select(*docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return dart_minhash.first_of_each_class(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that also start earlier; a text of which nothing is left goes.

    ``n_chars`` follows the text. A document that had no text to begin with stays as it is.
    """
    key, rest = fresh_names(docs, "row_key", "rest")
    left = (suffix_dedup.remaining(docs).filter("n_removed > 0")
            .select(F.col("rid").alias(key), F.col("left").alias(rest)).dropDuplicates([key]))
    joined = (docs.withColumn(key, row_key()).join(left, key, "left")
              .filter(F.col(rest).isNull() | (F.length(rest) > 0)))
    changed = F.col(rest).isNotNull()
    return joined.select(*(
        F.when(changed, F.col(rest)).otherwise(F.col("text")).alias("text") if c == "text" else
        F.when(changed, F.length(rest)).otherwise(F.col("n_chars")).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(c) for c in docs.columns))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark stands."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with how often each is used."""
    return mixing.select_documents(docs)
