"""Session helpers: a local session for tests and benches, and the checkpoint folder.

Library code never creates a session; it takes the caller's. The checkpoint
folder is read from the session (``spark.checkpoint.dir``); a scratch one is
set only where the session has none, which is the local test / bench case.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session built here gets. AQE re-plans joins from runtime sizes
# (the only broadcast decision we rely on is AQE's, which checks the measured
# size against spark.sql.autoBroadcastJoinThreshold) and splits skewed join
# partitions; ANSI mode makes bad casts fail loudly instead of producing nulls.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (never used by library code)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the session names, or None."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` must name shared storage and is used
    as is. The fallback below is for local sessions (tests, benches, the
    driver's local harness), where a folder under the system temp dir is shared
    by the single JVM.
    """
    d = checkpoint_dir(spark)
    if d:
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: intermediate "
                           "stages are written there and must survive executor loss")
    base = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_SCOPES: list[list[str]] = []


def _scratch_db(spark: SparkSession) -> str:
    """A database for written stages, located under the checkpoint folder."""
    db = "strata_scratch_" + "".join(ch if ch.isalnum() else "_"
                                     for ch in spark.sparkContext.applicationId)
    root = ensure_checkpoint_dir(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}.db'")
    return db


def write_stage(df, name: str = "stage") -> str:
    """Write ``df`` as a managed parquet table in the scratch database; returns its name.

    Inside ``scratch_scope`` the table is dropped (files included) when the
    scope ends; outside one it lives with the checkpoint folder.
    """
    spark = df.sparkSession
    table = f"{_scratch_db(spark)}.{name}_{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    if _SCOPES:
        _SCOPES[-1].append(table)
    return table


class scratch_scope:
    """Drop the stages written inside the ``with`` block when it ends.

    Use it around work whose results are written to real tables (a pipeline
    run); DataFrames that still read a stage must be consumed inside it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        _SCOPES.append([])
        return self

    def __exit__(self, *exc):
        for table in _SCOPES.pop():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        return False


def materialize(df, name: str = "stage"):
    """Write ``df`` once under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor never reruns the upstream joins), is
    computed exactly once (a reliable ``DataFrame.checkpoint`` runs its plan
    twice: once to count, once to write), and the read-back carries exact
    sizes, so AQE can choose broadcasts from measured bytes.
    """
    return materialize_counted(df, name)[0]


def materialize_counted(df, name: str = "stage"):
    """``materialize`` plus the number of rows written, observed during the write."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    table = write_stage(df.observe(obs, F.count(F.lit(1)).alias("rows")), name)
    return df.sparkSession.table(table), int(obs.get["rows"])
