"""Every registered query against its DuckDB oracle on the smallest tables (the driver's check)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, _digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


OWN = set(entry.queries()) - set(entry.llm.QUERIES if entry.llm else ()) - {"pipeline"}


def test_every_query_has_an_oracle():
    assert OWN <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF).toPandas()
    ddf = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert _digest(sdf)[0] == _digest(ddf)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema


@pytest.mark.parametrize("name", ["ranking_mart", "value_mart", "global_position"])
def test_no_single_task_window(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
