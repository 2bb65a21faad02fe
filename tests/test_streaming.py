"""Incremental bronze ingest: each landing file is ingested exactly once."""

import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import StructType

from strata.streaming import ingest_new_files

DDL = ("condition STRING, price DOUBLE, reviews STRING, ingestion_timestamp TIMESTAMP_NTZ, "
       "source_file STRING, record_id STRING")


def _file(d, name, body):
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}", "w") as f:
        f.write("Condition,Price,Reviews\n" + body)


def test_new_files_once(spark, scratch):
    schema = StructType.fromDDL(DDL)
    land, out = f"{scratch}/landing", f"{scratch}/bronze"
    _file(land, "a.csv", "pain,1.5,12 Reviews\nskin,n/a,3\n")
    ck = f"{scratch}/ck"
    assert ingest_new_files(spark, land, schema, out, datetime(2024, 1, 1), checkpoint=ck) == 2
    _file(land, "b.csv", "gout,2.0,1\n")
    assert ingest_new_files(spark, land, schema, out, datetime(2024, 1, 2), checkpoint=ck) == 1
    assert ingest_new_files(spark, land, schema, out, datetime(2024, 1, 3), checkpoint=ck) == 0
    rows = spark.read.parquet(out).collect()
    assert sorted((r["condition"], r["price"]) for r in rows if r["price"] is not None) == \
        [("gout", 2.0), ("pain", 1.5)]
    assert len(rows) == 3 and {r["source_file"].rsplit("/", 1)[1] for r in rows} == \
        {"a.csv", "b.csv"}


_RUN = """
import sys
from datetime import datetime
from pyspark.sql.types import StructType
from strata.session import local_session
from strata.streaming import ingest_new_files
spark = local_session(1, 1)
print("rows", ingest_new_files(spark, sys.argv[1], StructType.fromDDL(sys.argv[4]), sys.argv[2], datetime(2024, 1, 1),
                               checkpoint=sys.argv[3]))
"""


def test_two_processes_lose_no_file(spark, scratch):
    """A second session with the same checkpoint reads what is new, and only that."""
    land, out, ck = (f"{scratch}/{n}" for n in ("landing", "bronze", "ck"))
    schema = StructType.fromDDL(DDL)
    _file(land, "a.csv", "pain,1.5,12 Reviews\n")
    assert ingest_new_files(spark, land, schema, out, datetime(2024, 1, 1), checkpoint=ck) == 1
    _file(land, "b.csv", "gout,2.0,1\ngout,3.0,1\n")
    done = subprocess.run([sys.executable, "-c", _RUN, land, out, ck, DDL], capture_output=True, text=True, timeout=300)
    assert "rows 2" in done.stdout, done.stderr[-2000:]
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(ValueError, match="checkpoint"):
        ingest_new_files(spark, land, schema, out, datetime(2024, 1, 1), checkpoint=f"{scratch}/other")


def test_reordered_header_is_refused(spark, scratch):
    land, schema = f"{scratch}/landing", StructType.fromDDL(DDL)
    os.makedirs(land)
    with open(f"{land}/a.csv", "w") as f:
        f.write("Reviews,Condition,Price\n7 R,gout,2.0\n")
    with pytest.raises(StreamingQueryException):
        ingest_new_files(spark, land, schema, f"{scratch}/out", datetime(2024, 1, 1), checkpoint=f"{scratch}/ck")


# --- ingest with checks ----------------------------------------------------------------------

def _checked(spark, scratch, **options):
    from datetime import datetime

    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    from strata.streaming import checked
    schema = StructType.fromDDL("a STRING, n INT, ingestion_timestamp TIMESTAMP_NTZ, source_file STRING, record_id STRING")
    rules = {"has_a": F.col("a").isNotNull(), "positive": F.col("n") > 0}
    places = [f"{scratch}/{x}" for x in ("target", "quarantine", "audit")]
    return checked.ingest_checked(spark, f"{scratch}/feed", schema, rules, *places, datetime(2024, 1, 1), f"{scratch}/checkpoint", **options)


def _tables(spark, scratch):
    return [sorted(map(repr, spark.read.parquet(f"{scratch}/{x}").select(*cols).collect())) for x, cols in (
        ("target", ["batch", "a", "n"]), ("quarantine", ["batch", "a", "n", "failed_rules"]),
        ("audit", ["batch", "rows", "valid_rows", "quarantined_rows", "failures"]))]


def _feed(scratch, name, text):
    import os
    os.makedirs(f"{scratch}/feed", exist_ok=True)
    with open(f"{scratch}/feed/{name}.csv", "w") as f:
        f.write("a,n\n" + text)


def test_a_batch_run_again_leaves_the_same_tables(spark, scratch, monkeypatch):
    import pytest

    from strata.streaming import checked
    _feed(scratch, "one", "x,1\n,2\ny,-1\nz,q\n")
    _checked(spark, scratch)
    first = _tables(spark, scratch)
    assert [len(t) for t in first] == [1, 3, 1] and "quarantined_rows=3" in first[2][0]
    _feed(scratch, "two", "v,5\n,\n")
    put, calls = checked._put, []

    def dies(df, folder, batch):
        calls.append(folder)
        if len(calls) == 2:                   # the valid rows are written, the others not
            raise RuntimeError("lost")
        put(df, folder, batch)
    monkeypatch.setattr(checked, "_put", dies)
    with pytest.raises(Exception, match="lost"):
        _checked(spark, scratch)
    monkeypatch.setattr(checked, "_put", put)
    audit = _checked(spark, scratch)
    assert sorted((r.batch, r["rows"], r.valid_rows, r.failures["has_a"]) for r in audit.collect()) == [(0, 4, 1, 1), (1, 2, 1, 1)]
    done = _tables(spark, scratch)
    assert [len(t) for t in done] == [2, 4, 2]
    # nothing new: nothing changes
    _checked(spark, scratch)
    assert _tables(spark, scratch) == done


def test_many_batches(spark, scratch):
    for k in range(3):
        _feed(scratch, f"f{k}", f"a{k},{k}\n")
    audit = _checked(spark, scratch, max_files_per_batch=1)
    assert audit.count() == 3 and spark.read.parquet(f"{scratch}/target").count() == 2


def test_a_batch_of_one_file_is_dealt_over_all_cores(spark, scratch):
    from strata.streaming import checked
    _feed(scratch, "one", "same,1\n" * 400 + ",2\n" * 100)
    one = spark.read.csv(f"{scratch}/feed", header=True, schema="a string, n int")
    assert one.rdd.getNumPartitions() == 1
    parts = checked._spread(one).rdd.glom().map(len).collect()
    assert sum(parts) == 500 and len(parts) == spark.sparkContext.defaultParallelism and min(parts) > 100    # copies too
    audit = _checked(spark, scratch)
    row = audit.first()
    assert (row["rows"], row.valid_rows, row.failures["has_a"]) == (500, 400, 100)
    assert len(spark.read.parquet(f"{scratch}/target").inputFiles()) == len(parts)
