"""Hash keys, record ids and lineage columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cleanse import ColumnOrName, _col
from .timestamps import ts_lit

# Fixed value: separator of composite keys and record ids.
KEY_SEPARATOR = "||"


def hash_key(c: ColumnOrName) -> Column:
    """md5 hex of one text column; null in -> null out."""
    return F.md5(_col(c).cast("string"))


def composite_key(*cols: ColumnOrName) -> Column:
    """md5(concat_ws('||', ...)): nulls are skipped, as in the original keys."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[_col(c).cast("string") for c in cols]))


def record_id(cols: Sequence[ColumnOrName], style: str = "reference") -> Column:
    """Content hash of a row.

    ``reference``: md5 of the '||'-joined text, nulls skipped, so (a, null, b) and
    (a, b, null) collide. ``unambiguous``: md5 of a JSON array of the values, which
    keeps nulls and positions apart.
    """
    parts = [_col(c).cast("string") for c in cols]
    if style == "reference":
        return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
    if style == "unambiguous":
        return F.md5(F.to_json(F.array(*parts)))
    raise ValueError(f"unknown record id style {style!r}")


def with_lineage(df: DataFrame, run_ts: datetime, source_file: Column | str | None = None,
                 id_style: str = "reference", ts_col: str = "ingestion_timestamp",
                 file_col: str = "source_file", id_col: str = "record_id") -> DataFrame:
    """Add ingestion time (one injected instant per run), source file and record id.

    The record id hashes the source columns only (those present before the
    lineage columns are added). ``source_file`` defaults to the scan's
    ``_metadata.file_path``.
    """
    src = list(df.columns)
    if source_file is None:
        file_expr = F.col("_metadata.file_path")
    elif isinstance(source_file, str):
        file_expr = F.lit(source_file)
    else:
        file_expr = source_file
    return df.select(
        *[F.col(c) for c in src],
        ts_lit(run_ts).alias(ts_col),
        file_expr.alias(file_col),
        record_id(src, id_style).alias(id_col),
    )
