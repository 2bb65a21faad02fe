"""Incremental ingest with quality checks: valid rows, quarantine and audit in one repeatable step a batch.

Every micro-batch of the feed's new files is judged by the rules and written to three Parquet
tables, each partitioned by the batch's number: valid rows, rows that fail with the names of the
rules, and one audit row with the counts. A batch overwrites exactly its own partitions, so a batch that is
run again after a failure (Spark hands out the same number for the same files) leaves what one
run leaves, whichever of the tables had been written before. The audit row comes last: a batch that has one is complete.

The checkpoint folder is the stream's memory, on shared storage, one for the three tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timestamps import ts_lit
from ..operators import quality
from .ingest import stream_feed

BATCH = "batch"
_AUDIT = "rows long, valid_rows long, quarantined_rows long, failures map<string,long>"


def _put(df: DataFrame, folder: str, batch: int) -> None:
    (df.withColumn(BATCH, F.lit(batch).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(folder))


def _spread(df: DataFrame) -> DataFrame:
    """The batch dealt over all cores: a file that may hold line breaks is parsed by one task, and a batch holds few files.

    Rows go by their place in the batch, not in turn (``repartition(n)``, which sorts every row first so that a
    task run again deals alike) and not by content (copies would meet in one task).
    """
    place = "__place"
    return (df.withColumn(place, F.monotonically_increasing_id())
            .repartition(df.sparkSession.sparkContext.defaultParallelism, place).drop(place))


def write_batch(df: DataFrame, batch: int, rules: Mapping[str, Column], target: str, quarantine: str, audit: str,
                run_ts: datetime) -> None:
    """One batch into the three tables; doing it again changes nothing."""
    if BATCH in df.columns:
        raise ValueError(f"the feed has a column {BATCH!r}")
    flagged = quality.flag(_spread(df), rules).persist()       # read and judged once; a lost part is read again from its file
    try:
        _put(flagged.filter(F.size(quality.FAILED) == 0).drop(quality.FAILED), target, batch)
        _put(flagged.filter(F.size(quality.FAILED) > 0), quarantine, batch)
        bad = F.size(quality.FAILED) > 0
        failures = F.map_from_arrays(F.array(*(F.lit(n) for n in rules)), F.array(*(
            F.count_if(F.array_contains(quality.FAILED, n)) for n in rules)))
        _put(flagged.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~bad).alias("valid_rows"),
                         F.count_if(bad).alias("quarantined_rows"), failures.alias("failures"))
             .withColumn("load_timestamp", ts_lit(run_ts)), audit, batch)
    finally:
        flagged.unpersist()


def ingest_checked(spark: SparkSession, source_dir: str, schema: StructType, rules: Mapping[str, Column], target: str,
                   quarantine: str, audit: str, run_ts: datetime, checkpoint: str, **feed) -> DataFrame:
    """Take in every file not seen yet; returns the audit table. ``feed``: options of ``stream_feed``."""
    q = (stream_feed(spark, source_dir, schema, run_ts, **feed).writeStream
         .foreachBatch(lambda df, batch: write_batch(df, batch, rules, target, quarantine, audit, run_ts))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return audit_table(spark, audit)


def audit_table(spark: SparkSession, audit: str) -> DataFrame:
    """The audit rows; empty before the first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(audit)
    schema = f"{_AUDIT}, load_timestamp timestamp_ntz, {BATCH} long"
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(audit)
