"""Reading the corpus tables and writing intermediate stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows rereads shared files after an executor is
    lost instead of running everything above again, and nothing is computed
    twice when the result is used twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for internal columns that ``df`` does not have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(doc_id: str = "doc_id", text: str = "text"):
    """64-bit key of a row: equal for rows that agree in id and text, whatever else they hold."""
    return F.xxhash64(F.lit(17), F.col(doc_id), F.col(text))
