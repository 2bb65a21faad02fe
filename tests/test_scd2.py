"""SCD2 merge (R1, R2, P6, J1-J3, U1) and hazards H2-H4, H11, H17, H21."""

import random
from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.operators import scd2

SPEC = scd2.Scd2Spec(keys=("key",), tracked=("price", "type"))
D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
SNAP = "key string, price double, type string, note string"
HIST = SNAP + ", effective_date date, end_date date, is_current boolean"


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_initial_load(spark):
    s = spark.createDataFrame([("a", 1.0, "RX", "x")], SNAP)
    out = scd2.apply(None, s, SPEC, D1)
    assert rows(out) == [("a", 1.0, "RX", "x", D1, None, True)]


def test_merge_outcomes(spark):
    hist = spark.createDataFrame([
        ("same", 1.0, "RX", "n", D1, None, True),
        ("chg", 1.0, "RX", "n", D1, None, True),
        ("to_val", None, "RX", "n", D1, None, True),
        ("to_null", 1.0, "RX", "n", D1, None, True),
        ("untracked", 1.0, "RX", "old note", D1, None, True),
        ("gone", 1.0, "RX", "n", D1, None, True),
        ("chg", 0.5, "RX", "n", date(2023, 1, 1), D1, False),
        ("nullflag", 1.0, "RX", "n", D1, None, None),
    ], HIST)
    snap = spark.createDataFrame([
        ("same", 1.0, "RX", "n"), ("chg", 2.0, "RX", "n"), ("to_val", 3.0, "RX", "n"),
        ("to_null", None, "RX", "n"), ("untracked", 1.0, "RX", "new note"),
        ("new", 9.0, "OTC", "n"),
    ], SNAP)
    obs = Observation("o")
    out = scd2.merge(hist, snap, SPEC, D2, observation=obs)
    got = rows(out)
    exp = sorted([
        ("same", 1.0, "RX", "n", D1, None, True),
        ("chg", 1.0, "RX", "n", D1, D2, False), ("chg", 2.0, "RX", "n", D2, None, True),
        ("to_val", None, "RX", "n", D1, D2, False), ("to_val", 3.0, "RX", "n", D2, None, True),
        ("to_null", 1.0, "RX", "n", D1, D2, False), ("to_null", None, "RX", "n", D2, None, True),
        ("untracked", 1.0, "RX", "old note", D1, None, True),   # untracked change: kept as is
        ("gone", 1.0, "RX", "n", D1, None, True),               # vanished key stays current
        ("chg", 0.5, "RX", "n", date(2023, 1, 1), D1, False),   # history kept
        ("nullflag", 1.0, "RX", "n", D1, None, False),          # null flag -> closed, kept
        ("new", 9.0, "OTC", "n", D2, None, True),
    ], key=repr)
    assert got == exp
    m = obs.get
    assert (m["new"], m["changed"], m["expired"], m["unchanged"], m["missing"]) == (1, 3, 3, 2, 1)


def test_close_missing(spark):
    hist = scd2.initial(spark.createDataFrame([("a", 1.0, "RX", "n")], SNAP), SPEC, D1)
    out = scd2.merge(hist, spark.createDataFrame([], SNAP), SPEC, D2, close_missing=True)
    assert rows(out) == [("a", 1.0, "RX", "n", D1, D2, False)]


def test_null_keys_drop_and_append(spark):
    hist = scd2.initial(spark.createDataFrame([("a", 1.0, "RX", "n")], SNAP), SPEC, D1)
    snap = spark.createDataFrame([("a", 1.0, "RX", "n"), (None, 2.0, "RX", "n")], SNAP)
    assert len(rows(scd2.merge(hist, snap, SPEC, D2))) == 1
    h2 = scd2.merge(hist, snap, SPEC, D2, null_keys="append")
    h3 = scd2.merge(h2, snap, SPEC, D3, null_keys="append")
    # the original's behaviour: null-key rows pile up as current rows
    assert sum(1 for r in h3.collect() if r["key"] is None and r["is_current"]) == 2


def test_duplicate_snapshot_key_raises(spark):
    hist = scd2.initial(spark.createDataFrame([("a", 1.0, "RX", "n")], SNAP), SPEC, D1)
    snap = spark.createDataFrame([("a", 1.0, "RX", "n"), ("a", 2.0, "RX", "n")], SNAP)
    with pytest.raises(scd2.DuplicateKeyError):
        scd2.merge(hist, snap, SPEC, D2)


def test_extra_and_missing_columns(spark):
    hist = scd2.initial(spark.createDataFrame([("a", 1.0, "RX", "n")], SNAP), SPEC, D1)
    snap = spark.createDataFrame([("a", 2.0, "RX", "z")], "key string, price double, "
                                 "type string, extra string")
    out = scd2.merge(hist, snap, SPEC, D2)
    assert set(out.columns) >= {"extra", "note"}
    cur = [r for r in out.collect() if r["is_current"]][0]
    assert cur["extra"] == "z" and cur["note"] is None
    with pytest.raises(ValueError):
        scd2.merge(hist, snap.drop("type"), SPEC, D2)


def test_same_day_rerun_idempotent_and_zero_length(spark):
    snap = spark.createDataFrame([("a", 1.0, "RX", "n"), ("b", 2.0, "OTC", "n")], SNAP)
    h1 = scd2.initial(snap, SPEC, D1)
    assert rows(scd2.merge(h1, snap, SPEC, D1)) == rows(h1)
    h2 = scd2.merge(h1, snap.withColumn("price", F.col("price") + 1), SPEC, D1)
    zero = [r for r in h2.collect() if r["effective_date"] == r["end_date"]]
    assert len(zero) == 2                      # closed the same day it opened
    assert rows(scd2.as_of_view(h2, SPEC, D1), "key", "price") == [("a", 2.0), ("b", 3.0)]


def test_composite_key(spark):
    spec = scd2.Scd2Spec(keys=("k1", "k2"), tracked=("v",))
    s1 = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("b", None, 1)],
                               "k1 string, k2 string, v int")
    h = scd2.apply(None, s1, spec, D1, null_keys="append")
    s2 = spark.createDataFrame([("a", "x", 2), ("a", "z", 1), ("b", None, 1)],
                               "k1 string, k2 string, v int")
    out = scd2.merge(h, s2, spec, D2, null_keys="append")
    cur = sorted((r["k1"], r["k2"], r["v"]) for r in out.collect() if r["is_current"])
    assert cur == sorted([("a", "x", 2), ("a", "y", 1), ("a", "z", 1), ("b", None, 1),
                          ("b", None, 1)], key=repr)


def test_switch_and_views(spark):
    snap = spark.createDataFrame([("a", 1.0, "RX", "n")], SNAP)
    assert scd2.apply(None, snap, SPEC, D1, enabled=False).columns == snap.columns
    h = scd2.merge(scd2.initial(snap, SPEC, D1), snap.withColumn("price", F.lit(5.0)), SPEC, D2)
    assert rows(scd2.health(h, SPEC)) == [(2, 1, 1)]
    assert rows(scd2.closed_versions(h, SPEC), "price") == [(1.0,)]
    v = scd2.versions(h, SPEC, keys=["a"])
    assert rows(v, "price", "version_number", "version_count") == [(1.0, 2, 2), (5.0, 1, 2)]


def _model_merge(hist, snap, day):
    """Pure-Python SCD2 model: list of dicts."""
    out = [dict(r) for r in hist if not r["cur"]]
    cur = {r["key"]: dict(r) for r in hist if r["cur"]}
    for k, r in cur.items():
        if k in snap and (snap[k]["price"], snap[k]["type"]) != (r["price"], r["type"]):
            out.append(dict(r, end=day, cur=False))
            out.append(dict(snap[k], key=k, eff=day, end=None, cur=True))
        else:
            out.append(r)
    for k, s in snap.items():
        if k not in cur:
            out.append(dict(s, key=k, eff=day, end=None, cur=True))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_model_random_sequences(spark, seed):
    rnd = random.Random(seed)
    keys = [f"k{i}" for i in range(30)]
    model, hist = [], None
    for step in range(4):
        day = date(2024, 1 + step, 1)
        snap = {}
        for k in keys:
            if rnd.random() < 0.8:
                snap[k] = {"price": rnd.choice([None, 1.0, 2.0]), "type": rnd.choice(["RX", None])}
        sdf = spark.createDataFrame([(k, v["price"], v["type"], "n") for k, v in snap.items()],
                                    SNAP)
        hist = scd2.apply(hist, sdf, SPEC, day)
        hist = spark.createDataFrame(hist.collect(), hist.schema)   # materialise between loads
        model = _model_merge(model, snap, day) if step else [
            dict(v, key=k, eff=day, end=None, cur=True) for k, v in snap.items()]
        got = sorted(repr((r["key"], r["price"], r["type"], r["effective_date"], r["end_date"],
                           r["is_current"])) for r in hist.collect())
        want = sorted(repr((m["key"], m["price"], m["type"], m["eff"], m["end"], m["cur"]))
                      for m in model)
        assert got == want
        # invariants: one current row per key; intervals do not overlap
        cur = [r["key"] for r in hist.collect() if r["is_current"]]
        assert len(cur) == len(set(cur))


def test_plan_is_one_full_outer_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hist = scd2.initial(spark.createDataFrame([("a", 1.0, "RX", "n")], SNAP), SPEC, D1)
        snap = spark.createDataFrame([("a", 2.0, "RX", "n")], SNAP)
        plan = scd2.merge(hist, snap, SPEC, D2, validate=False)._jdf.queryExecution() \
            .executedPlan().toString()
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
        assert "FullOuter" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
