"""A corpus pipeline of five training-data operators, each stage written and reread.

Quality rules, MinHash near-dedup, suffix-array dedup, benchmark decontamination,
mixing to target weights. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import stages
from strata.llm.tables import stage, table

STAGES = [
    ("quality_rules", stages.quality_stage),
    ("near_dedup", stages.near_dedup_stage),
    ("suffix_dedup", stages.suffix_dedup_stage),
    ("decontaminate", stages.decontaminate_stage),
    ("mix", stages.mixing_stage),
]

#: the stages use a tokenizer's vocabulary, signatures and byte-level repeats, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
