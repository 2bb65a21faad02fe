"""Run ledger: which stage of which run has finished on which input, so a rerun goes on where one stopped.

One row is appended when a stage starts and one when it has finished with all its tables and
audit rows. ``inputs`` names what the stage read: for the first stage a fingerprint of its files
(path, length, modification time, taken by Spark), for a later one the entry of the stage
before it. A stage is skipped only if it finished in the same run on the same input; whatever
follows a stage that ran again has other inputs and runs again too.

The table is append-only and small (two rows a stage and run); an interrupted append leaves nothing.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import append_table, exists

STARTED, FINISHED = "started", "finished"
SCHEMA = "run_id string, stage string, inputs string, state string, rows_written string"


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the files under ``paths``: their places, lengths and modification times, not their contents."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
             .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)").alias("h"), "length"))
    r = files.agg(F.count("*"), F.sum("length"), F.sum("h")).first()
    return hashlib.sha256(repr(tuple(map(str, r))).encode()).hexdigest()[:32]


class RunLedger:
    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.table):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.table(self.table)

    def _append(self, *row: str | None) -> None:
        append_table(self.spark.createDataFrame([row], SCHEMA), self.table)

    def start(self, run_id: str, stage: str, inputs: str) -> None:
        self._append(run_id, stage, inputs, STARTED, None)

    def finish(self, run_id: str, stage: str, inputs: str, rows: dict[str, int]) -> None:
        self._append(run_id, stage, inputs, FINISHED, json.dumps(rows, sort_keys=True))

    def finished(self, run_id: str, stage: str, inputs: str) -> dict[str, int] | None:
        """The rows that the stage wrote, if it has finished in this run on this input."""
        found = (self.rows().filter((F.col("run_id") == run_id) & (F.col("stage") == stage)
                                    & (F.col("inputs") == inputs) & (F.col("state") == FINISHED))
                 .select("rows_written").limit(1).collect())
        return json.loads(found[0][0]) if found else None

    @staticmethod
    def entry(run_id: str, stage: str, inputs: str) -> str:
        """What the next stage reads: this stage's result."""
        return hashlib.sha256(json.dumps([run_id, stage, inputs]).encode()).hexdigest()[:32]
