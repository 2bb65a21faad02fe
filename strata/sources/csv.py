"""CSV ingest: header normalising, contract typing and lineage columns, no inference pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.cleanse import to_snake
from ..functions.keys import record_id
from ..functions.timestamps import ts_lit
from .contracts import ConformReport, conform

# CSV dialect of the feeds: header row, comma, double-quote quoting. multiLine
# keeps a quoted CR LF inside one field (without it the row is split in two);
# it costs splitting: a multi-line file is read by one task, so big feeds
# should arrive as many files.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_text_csv(spark: SparkSession, path: str, multiline: bool = True,
                  unreadable_col: str | None = None, **options) -> DataFrame:
    """All columns as text, names from the header, snake-cased; plus ``source_file``.

    With ``unreadable_col`` a record that the parser cannot cut into the header's columns
    (too few or too many fields, a quote that is not closed) has its text there; it is null for all others.
    A feed whose records never hold a line break is read with ``multiline=False``: its files
    are then split among tasks, and an unclosed quote spoils one line, not the rest of its file.

    Only one header line is read to learn the names (no type inference job); a
    file whose own header names other columns, or names them in another order,
    fails the read (``enforceSchema=false``) instead of swapping values.
    """
    opts = dict(CSV_OPTIONS, multiLine=str(multiline).lower(), **options)
    header = spark.read.options(**opts).csv(path).columns
    names = [to_snake(c) for c in header]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"header names collide after normalising: {sorted(dup)}")
    fields = [StructField(c, StringType()) for c in header]
    extra = []
    if unreadable_col:
        if unreadable_col in (*header, *names):
            raise ValueError(f"the feed has a column {unreadable_col!r}")
        fields.append(StructField(unreadable_col, StringType()))
        # whether a record fits is judged on all its fields, whichever are asked for
        opts |= {"columnNameOfCorruptRecord": unreadable_col, "columnPruning": "false"}
        # Spark refuses queries that ask for this column alone, so it also names the first field (of which it adds nothing)
        extra = [F.concat(F.col(f"`{unreadable_col}`"), F.substring(F.coalesce(F.col(f"`{header[0]}`"), F.lit("")), 1, 0))
                 .alias(unreadable_col)]
    raw = spark.read.options(**opts, enforceSchema="false").schema(StructType(fields)).csv(path)
    return raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(header, names)], *extra,
                      F.col("_metadata.file_path").alias("source_file"))


def ingest(spark: SparkSession, path: str, schema: StructType, run_ts: datetime,
           id_style: str = "reference", multiline: bool = True,
           errors_col: str | None = None,
           unreadable_col: str | None = None) -> tuple[DataFrame, ConformReport]:
    """Bronze ingest of one CSV path: typed to ``schema`` plus lineage (and ``unreadable_col``, see above).

    ``record_id`` hashes the source columns as text (as read), in contract
    order; ``ingestion_timestamp`` is the injected run time; ``source_file`` is
    the file each row came from.
    """
    text = read_text_csv(spark, path, multiline, unreadable_col)
    data_fields = [f for f in schema.fields
                   if f.name not in ("ingestion_timestamp", "source_file", "record_id")]
    present = [f.name for f in data_fields if f.name in text.columns]
    with_id = text.withColumn("record_id", record_id(present, id_style))
    typed, rep = conform(with_id, StructType(data_fields), errors_col=errors_col,
                         keep_extra=True)
    rep.extra = [c for c in rep.extra if c not in ("source_file", "record_id", unreadable_col)]
    result = typed.select(
        *[F.col(f.name) for f in data_fields],
        *([F.col(errors_col)] if errors_col else []),
        *([F.col(unreadable_col)] if unreadable_col else []),
        ts_lit(run_ts).alias("ingestion_timestamp"),
        F.col("source_file"),
        F.col("record_id"))
    return result, rep
