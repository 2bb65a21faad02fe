"""Plan properties of every registered query: JVM-only, filters pushed to the scans."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# queries whose result is a stored table (their plans are table scans)
TABLE_READS = {"pipeline_run", "audit_rows", "audit_latest", "csv_roundtrip",
               "bronze_incremental", "scd2_off", "group_lookup", "dirty_feed_audit"}
# the training-data operators say for themselves where Python runs
OTHERS = set(entry.llm.QUERIES if entry.llm else ()) | {"pipeline"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - TABLE_READS - OTHERS))
def test_no_python_in_plan(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name}: {node}"


def test_filters_reach_the_scan(spark):
    from strata.plans import analogs
    snap = plan(analogs.item_snapshot(spark, SF, analogs.LOADS[1]))
    assert "GreaterThanOrEqual(l_shipdate" in snap and "LessThan(l_shipdate" in snap
    raw = plan(analogs.raw_feed(spark, SF))     # the bronze feed the silver queries write
    assert "EqualTo(l_linestatus,F)" in raw
    seen = plan(entry.queries()["first_seen"](spark, SF))
    assert "LessThan(ts," in seen


def test_star_reads_only_needed_columns(spark):
    p = plan(entry.queries()["summary_mart"](spark, SF))
    assert "l_shipdate" not in p and "o_totalprice" not in p and "c_name" not in p


def test_fact_sized_aggregates_are_hash_based(spark):
    """A non-fixed-width buffer (struct, text) would make Spark sort every fact row to
    aggregate; the star's pre-aggregate and the snapshot aggregate must stay hash-based."""
    from strata.plans import analogs, marts
    import re

    def raw_rows_aggregate(p):
        # the last aggregate in the plan text is the partial one reading the raw rows
        return re.findall(r"(SortAggregate|ObjectHashAggregate|HashAggregate)", p)[-1]

    base = plan(marts.base(analogs.review_star(spark, SF), analogs.analog_mart_spec()))
    assert "SortAggregate" not in base and "ObjectHashAggregate" not in base
    assert raw_rows_aggregate(plan(analogs.item_snapshot(spark, SF, analogs.EVERYTHING))) == "HashAggregate"
