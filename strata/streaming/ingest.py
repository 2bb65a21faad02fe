"""Incremental bronze ingest with Structured Streaming.

The batch ingest (``sources.csv.ingest``) re-reads every file of a feed on each
run. At scale, feeds arrive as new files in a landing folder; this job reads
each new file exactly once: a file-stream source tracks what it has seen in
the query's checkpoint, ``trigger(availableNow=True)`` processes everything new
and stops, and the parquet file sink commits each micro-batch atomically, so a
lost executor or a rerun never duplicates or drops a file.

A stream needs its schema up front, so the contract's source columns are read
in their order and every file's header must agree with them
(``enforceSchema=false``): a file with its columns in another order fails the run
instead of swapping values. Values are typed with ``try_cast`` exactly as the
batch ingest does, with the same lineage columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.keys import record_id
from ..functions.timestamps import ts_lit
from ..sources.csv import CSV_OPTIONS

_LINEAGE = ("ingestion_timestamp", "source_file", "record_id")


def stream_feed(spark: SparkSession, source_dir: str, schema: StructType, run_ts: datetime,
                id_style: str = "reference", max_files_per_batch: int | None = None,
                multiline: bool = True, headers: dict[str, str] | None = None) -> DataFrame:
    """Streaming DataFrame of a CSV landing folder, typed to ``schema`` plus lineage.

    ``headers`` maps a contract column to its header text where they differ.
    """
    fields = [f for f in schema.fields if f.name not in _LINEAGE]
    headers = headers or {}
    text_schema = StructType([StructField(headers.get(f.name, f.name), StringType()) for f in fields])
    options = dict(CSV_OPTIONS, multiLine=str(multiline).lower(), enforceSchema="false")
    reader = spark.readStream.format("csv").options(**options).schema(text_schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    raw = reader.load(source_dir)
    names = [f.name for f in fields]
    raw = raw.select(*[F.col(f"`{headers.get(n, n)}`").alias(n) for n in names],
                     F.col("_metadata.file_path").alias("source_file"))
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields],
        ts_lit(run_ts).alias("ingestion_timestamp"),
        F.col("source_file"),
        record_id(names, id_style).alias("record_id"))


def ingest_new_files(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                     run_ts: datetime, checkpoint: str, **kw) -> int:
    """Append every not-yet-seen file of ``source_dir`` to the parquet folder ``target``.

    Returns the number of rows appended by this run. ``checkpoint`` is the
    stream's memory of what it has read: it must be the same folder, on shared
    storage, in every run for one target, and belongs to no session. A target that
    was written before is refused with an empty checkpoint, because its sink would
    skip the new query's first batches as already committed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    before = 0
    if fs.exists(path(f"{target}/_spark_metadata")):
        if not path(checkpoint).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(checkpoint)):
            raise ValueError(f"{target} was written by a stream whose checkpoint is not {checkpoint}")
        before = spark.read.parquet(target).count()
    q = (stream_feed(spark, source_dir, schema, run_ts, **kw)
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start(target))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    # counted in the target's file footers: a query keeps only its last progress reports
    return (spark.read.parquet(target).count() if fs.exists(path(f"{target}/_spark_metadata")) else 0) - before
