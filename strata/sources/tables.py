"""Table sinks: full replace by a moved pointer, append, and the audit log.

``replace_table`` writes a new version of the table into a folder of its own and then moves
the catalog's pointer there, one change of the table's location. Readers see the old version or the
new one, never none: a query that has begun on the old version finishes on its files, which stay for ``keep_hours``.
Nothing is renamed, so a plan may read the table it replaces, and a write that
dies leaves the table as it was (its folder goes with the old versions).

Only where the new version has another layout (columns, buckets, partitions), or the table is
a managed one of an earlier release, the table is created anew: a drop and a rename, between which it is missing.
``recover`` finishes what such a swap left behind. The row count comes from an
``Observation`` collected during the write, not from a second scan.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .contracts import check, contract

STAGE, OLD = "__stage", "__old"
TABLE_FORMAT = "parquet"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def recover(spark: SparkSession, name: str) -> str | None:
    """Finish or undo an interrupted swap of ``name``; returns what was done."""
    done = None
    if not exists(spark, name) and exists(spark, name + OLD):
        spark.sql(f"ALTER TABLE {name}{OLD} RENAME TO {name}")
        done = "restored previous version"
    elif exists(spark, name) and exists(spark, name + OLD):
        spark.sql(f"DROP TABLE {name}{OLD}")
        done = "dropped old version"
    if exists(spark, name + STAGE):
        spark.sql(f"DROP TABLE {name}{STAGE}")
        done = (done + "; " if done else "") + "dropped unfinished stage"
    return done


def _layout(spark: SparkSession, name: str) -> dict:
    """What two versions must share for the pointer to move: columns, buckets, partitions; and the kind of table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    told = {r["col_name"]: r["data_type"] for r in rows}
    return {"columns": [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields],
            "partitions": "# Partition Information" in told, "external": told.get("Type") == "EXTERNAL",
            **{k: told.get(k) for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")}}


def _versions(spark: SparkSession, name: str) -> str:
    """The folder of a table's versions, beside the database's other tables."""
    db, _, table = name.rpartition(".")
    place = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{place}/{table}__versions"


def _drop_old_versions(spark: SparkSession, name: str, place: str, keep_hours: float) -> None:
    """Delete versions, other than the current one, that no query can still be reading."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(place)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    current = path(told["Location"]).getName()
    limit = (time.time() - keep_hours * 3600) * 1000
    for status in fs.listStatus(folder):
        if status.getPath().getName() != current and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)


def replace_table(df: DataFrame, name: str, schema: StructType | None = None,
                  partition_by: list[str] | None = None,
                  bucket_by: tuple[int, list[str]] | None = None,
                  observation: Observation | None = None, keep_hours: float = 24) -> int:
    """Replace table ``name`` by ``df``; returns the number of rows written.

    ``schema`` (a contract) is checked before anything is written.
    ``bucket_by=(n, cols)`` writes ``n`` buckets hashed and sorted on ``cols``:
    two tables bucketed the same way on their join key are joined without
    shuffling either side. ``keep_hours`` must be more than the longest query takes.
    """
    spark = df.sparkSession
    if schema is not None:
        check(df, schema)
    recover(spark, name)
    obs = observation or Observation(f"replace_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode("overwrite").format(TABLE_FORMAT)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    place = _versions(spark, name)
    version = f"{place}/{uuid.uuid4().hex}"
    w.option("path", version).saveAsTable(name + STAGE)
    if exists(spark, name):
        old, new = _layout(spark, name), _layout(spark, name + STAGE)
        if old == new and not new["partitions"]:      # partitions have locations of their own
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
            spark.sql(f"DROP TABLE {name}{STAGE}")    # the name only: its files are the table's now
            _drop_old_versions(spark, name, place, keep_hours)
            return int(obs.get["rows"])
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{OLD}")
    spark.sql(f"ALTER TABLE {name}{STAGE} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}{OLD}")
    _drop_old_versions(spark, name, place, keep_hours)
    return int(obs.get["rows"])


def append_table(df: DataFrame, name: str, schema: StructType | None = None) -> int:
    """Append ``df`` to ``name`` (created if missing); returns the rows written."""
    if schema is not None:
        check(df, schema)
    obs = Observation(f"append_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append") \
        .format(TABLE_FORMAT).saveAsTable(name)
    return int(obs.get["rows"])


# --- audit log ------------------------------------------------------------------------

# Audit statuses.
SUCCESS, WARNING, FAILED = "success", "warning", "failed"


@dataclass(frozen=True)
class AuditRow:
    table_name: str
    source_file: str
    record_count: int | None
    load_timestamp: datetime
    layer: str
    status: str = SUCCESS
    notes: str = ""


def audit_frame(spark: SparkSession, rows: list[AuditRow]) -> DataFrame:
    """Audit rows (one per written table) under the audit contract."""
    schema = contract("metadata_tracking")
    data = [(r.table_name, r.source_file, r.record_count,
             r.load_timestamp.replace(tzinfo=None), r.layer, r.status, r.notes) for r in rows]
    return spark.createDataFrame(data, schema)


def append_audit(spark: SparkSession, name: str, rows: list[AuditRow]) -> int:
    if not rows:
        return 0
    return append_table(audit_frame(spark, rows), name, contract("metadata_tracking"))


def append_audit_once(spark: SparkSession, name: str, rows: list[AuditRow]) -> int:
    """Append the audit rows that the log does not hold yet: a rerun of one run adds nothing."""
    if not rows:
        return 0
    new = audit_frame(spark, rows).distinct()
    if exists(spark, name):
        times = sorted({r.load_timestamp.replace(tzinfo=None) for r in rows})
        same = spark.table(name).filter(F.col("load_timestamp").isin(times))
        cond = None
        for c in new.columns:
            t = new[c].eqNullSafe(same[c])
            cond = t if cond is None else cond & t
        new = new.join(same, cond, "left_anti")
    kept = new.collect()                     # a few rows, given by the caller
    if not kept:
        return 0
    return append_table(spark.createDataFrame(kept, contract("metadata_tracking")), name, contract("metadata_tracking"))


def latest_runs(audit: DataFrame, position: str | None = None) -> DataFrame:
    """Audit rows newest first (run monitoring); with ``position`` also numbered so."""
    order = [F.col("load_timestamp").desc_nulls_last(), F.col("layer"), F.col("table_name"), F.col("status")]
    if position:
        from ..operators.rank import global_position
        return global_position(audit, order, position, total=None)
    return audit.orderBy(*order)
