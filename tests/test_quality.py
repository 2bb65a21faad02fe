"""Quality rules and quarantine (Q1, Q2)."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators import quality


def test_split_partitions_input(spark):
    df = spark.createDataFrame([(1, 5.0, "ok"), (2, 0.5, "ok"), (3, 0.5, "error"),
                                (4, None, "ok")], "id int, v double, t string")
    rules = {"v_min": F.col("v") >= 1, "not_error": F.col("t") != "error"}
    obs = Observation("q")
    valid, bad = quality.split(df, rules, observation=obs)
    assert sorted(r["id"] for r in valid.collect()) == [1]
    got = {r["id"]: r["failed_rules"] for r in bad.collect()}
    assert got == {2: ["v_min"], 3: ["v_min", "not_error"], 4: ["v_min"]}  # null rule fails
    assert obs.get["quarantined_rows"] == 3 and obs.get["failed_v_min"] == 3
    c = quality.counts(df, rules).first()
    assert (c["rows"], c["valid_rows"], c["failed_not_error"]) == (4, 1, 1)


def test_enforce_policies(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    rules = {"x_present": F.col("x").isNotNull()}
    kept, stats = quality.enforce(df, rules, "drop")
    assert kept.count() == 1 and stats["quarantined_rows"] == 1
    import pytest
    with pytest.raises(ValueError):
        quality.enforce(df, rules, "fail")
