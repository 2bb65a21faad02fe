"""A Type 2 history as a table that loads touch only where they change it.

The table is partitioned by the current flag and, among closed versions, by the load that
closed them. A load reads the current rows only, and writes two partitions: the versions it
closes, under its own name, and the current rows. Files of earlier loads are never read or
rewritten, so a load costs the live items, not the history.

Restart. The load's closed versions are written first, the current rows last, each by an
overwrite of exactly that partition. A load that dies in between is run again: the current rows are still
the old ones, so it closes the same versions under the same name. A load that is run again after
it has finished finds nothing to change. A second load under one name adds its closed versions to the first's.

The rules of a load are ``scd2.merge``'s.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import scd2
from .scd2 import Scd2Spec

#: partition column: the load that closed a version; LIVE for current ones
CLOSED_IN, LIVE = "closed_in", "live"


def history(spark: SparkSession, table: str, spec: Scd2Spec) -> DataFrame:
    """All versions, in the columns ``scd2`` works on."""
    df = spark.table(table)
    return df.select(*[c for c in df.columns if c not in (*spec.meta, CLOSED_IN)], *spec.meta)


def current(spark: SparkSession, table: str, spec: Scd2Spec) -> DataFrame:
    """Current versions: one partition is read."""
    return history(spark, table, spec).filter(F.col(spec.current))


def _write(df: DataFrame, table: str, spec: Scd2Spec, closed_in: str) -> None:
    """Overwrite the partition ``closed_in``: staged first, moved into its place when all is written."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")           # an insert into a table has no option for it
    try:
        df.withColumn(CLOSED_IN, F.lit(closed_in)).select(*columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def adopt(spark: SparkSession, table: str, spec: Scd2Spec,
          bucket_by: tuple[int, list[str]] | None = None) -> list[str] | None:
    """Make a table ready for ``load``; returns the columns of its history, or None if there is none.

    A history written as one table is rewritten once in partitions; a table without history is dropped.
    """
    if not spark.catalog.tableExists(table):
        return None
    columns = spark.table(table).columns
    if CLOSED_IN in columns:
        return [c for c in columns if c != CLOSED_IN]
    if not set(spec.meta) <= set(columns):
        spark.sql(f"DROP TABLE {table}")
        return None
    flag = F.coalesce(F.col(spec.current), F.lit(False))
    all_ = materialize(spark.table(table).withColumn(spec.current, flag)
                       .withColumn(CLOSED_IN, F.when(flag, F.lit(LIVE)).otherwise(F.lit("adopted"))), "scd2_adopted")
    spark.sql(f"DROP TABLE {table}")
    _partitioned(all_, spec, bucket_by).saveAsTable(table)
    return columns


def _partitioned(df: DataFrame, spec: Scd2Spec, bucket_by: tuple[int, list[str]] | None):
    w = df.write.format("parquet").partitionBy(spec.current, CLOSED_IN)
    return w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1]) if bucket_by else w


def load(snapshot: DataFrame, table: str, spec: Scd2Spec, as_of: date, *, name: str | None = None,
         bucket_by: tuple[int, list[str]] | None = None, **options) -> dict[str, int]:
    """Apply a snapshot to ``table`` (created if missing); returns the rows by outcome.

    ``name`` is the load's name in the table, by default its date.
    """
    spark = snapshot.sparkSession
    name = name or as_of.isoformat()
    if name == LIVE:
        raise ValueError(f"a load cannot be called {LIVE!r}")
    if not spark.catalog.tableExists(table):
        seen = Observation("scd2_first")
        first = scd2.apply(None, snapshot, spec, as_of, **options).observe(seen, F.count(F.lit(1)).alias(scd2.NEW))
        _partitioned(first.withColumn(CLOSED_IN, F.lit(LIVE)), spec, bucket_by).saveAsTable(table)
        return {k: v for k, v in seen.get.items() if v and k != "total"}
    seen = Observation("scd2_load")
    merged = materialize(scd2.merge(current(spark, table, spec), snapshot, spec, as_of, observation=seen, **options), "scd2_load")
    closed = merged.filter(~F.col(spec.current))
    if seen.get[scd2.EXPIRED] + seen.get[scd2.CLOSED_MISSING]:
        before = spark.table(table).filter(~F.col(spec.current) & (F.col(CLOSED_IN) == name))
        # written apart first: a partition cannot be overwritten by a plan that reads it
        _write(materialize(closed.unionByName(before.select(*closed.columns)).dropDuplicates(), "scd2_closed"), table, spec, name)
    if seen.get["total"] > seen.get[scd2.UNCHANGED] + seen.get[scd2.MISSING]:
        _write(merged.filter(F.col(spec.current)), table, spec, LIVE)
    return {k: v for k, v in seen.get.items() if v and k != "total"}
