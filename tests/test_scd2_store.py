"""Histories that loads touch only where they change them, snapshots in any order, versions at a fact's time."""
import itertools
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators import asof, scd2, scd2_store, scd2_timeline
from strata.operators.scd2 import Scd2Spec

SPEC = Scd2Spec(keys=("k",), tracked=("price",))
SNAP = "k string, price double, note string"


def files(spark, table):
    place = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), place): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(place) for f in names if f.endswith(".parquet")}


def snapshots(n, seed=0):
    rnd = random.Random(seed)
    return [[(f"k{i}", rnd.choice([1.0, 2.0, None]), "n") for i in range(40) if rnd.random() < 0.9] for _ in range(n)]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def db(spark, scratch):
    name = f"t_store_{os.path.basename(scratch).replace('-', '_').lower()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch}/db'")
    return name


def test_loads_equal_the_whole_merge_and_leave_closed_files(spark, db):
    table, whole = f"{db}.h", None
    before = {}
    for n, rows in enumerate(snapshots(4)):
        snap, day = spark.createDataFrame(rows, SNAP), date(2024, 1, 1) + timedelta(n)
        whole = scd2.apply(whole, snap, SPEC, day)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        out = scd2_store.load(snap, table, SPEC, day)
        assert sum(out.values()) > 0
        own = scd2_store.history(spark, table, SPEC)
        assert as_rows(own) == as_rows(whole.select(*own.columns))
        now = files(spark, table)
        closed = {f: t for f, t in before.items() if "is_current=false" in f}
        assert closed.items() <= now.items()              # neither renamed nor rewritten
        before = now
    assert sum("is_current=false" in f for f in before) >= 3
    # a finished load run again changes no file
    assert scd2_store.load(snap, table, SPEC, day).keys() <= {"unchanged", "missing"}
    assert files(spark, table) == before


def test_a_load_that_died_is_run_again(spark, db, monkeypatch):
    table = f"{db}.h"
    first, second = (spark.createDataFrame(r, SNAP) for r in snapshots(2))
    scd2_store.load(first, table, SPEC, date(2024, 1, 1))
    whole = scd2.merge(
        scd2.apply(None, first, SPEC, date(2024, 1, 1)), second, SPEC, date(2024, 1, 2))
    write, done = scd2_store._write, []

    def dies(df, *a):
        if done:
            raise RuntimeError("lost")
        done.append(1)
        write(df, *a)
    monkeypatch.setattr(scd2_store, "_write", dies)
    with pytest.raises(RuntimeError):
        scd2_store.load(second, table, SPEC, date(2024, 1, 2))
    monkeypatch.setattr(scd2_store, "_write", write)
    scd2_store.load(second, table, SPEC, date(2024, 1, 2))
    own = scd2_store.history(spark, table, SPEC)
    assert as_rows(own) == as_rows(whole.select(*own.columns))


def test_a_second_load_of_one_day_keeps_the_first_ones_closed_versions(spark, db):
    table, day = f"{db}.h", date(2024, 1, 2)
    scd2_store.load(spark.createDataFrame([("a", 1.0, ""), ("b", 1.0, "")], SNAP), table, SPEC, date(2024, 1, 1))
    scd2_store.load(spark.createDataFrame([("a", 2.0, "")], SNAP), table, SPEC, day)
    scd2_store.load(spark.createDataFrame([("b", 2.0, "")], SNAP), table, SPEC, day)
    got = sorted((r.k, r.price, r.is_current) for r in scd2_store.history(spark, table, SPEC).collect())
    assert got == [("a", 1.0, False), ("a", 2.0, True), ("b", 1.0, False), ("b", 2.0, True)]


def test_current_reads_one_partition(spark, db):
    table = f"{db}.h"
    for n, rows in enumerate(snapshots(3)):
        scd2_store.load(spark.createDataFrame(rows, SNAP), table, SPEC, date(2024, 1, 1) + timedelta(n))
    plan = scd2_store.current(spark, table, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan


def timeline(loads):
    """Versions by gaps and islands over all observations, in plain Python."""
    seen = {}
    for day, rows in sorted(loads):
        for k, price, _ in rows:
            seen.setdefault(k, {})[day] = price
    out = []
    for k, obs in seen.items():
        versions = []
        for day in sorted(obs):
            if versions and versions[-1][1] == obs[day]:
                versions[-1][2].append(day)
            else:
                versions.append([day, obs[day], [day]])
        for n, (day, price, days) in enumerate(versions):
            end = versions[n + 1][0] if n + 1 < len(versions) else None
            out.append((k, price, day, end, end is None, days))
    return sorted(out, key=repr)


def test_snapshots_in_any_order_give_one_history(spark):
    loads = [(date(2024, 1, 1) + timedelta(10 * n), rows) for n, rows in enumerate(snapshots(3, seed=5))]
    want = timeline(loads)
    for order in itertools.permutations(loads):
        h = None
        for day, rows in order:
            h = scd2_timeline.merge_at(h, spark.createDataFrame(rows, SNAP), SPEC, day)
            h = spark.createDataFrame(h.collect(), h.schema)
        got = as_rows(h.select("k", "price", "effective_date", "end_date", "is_current", "observed_on"))
        assert got == want


def test_late_value_between_two_equal_ones_and_repeats(spark):
    days = [date(2024, 1, d) for d in (1, 2, 3, 4)]
    one = [[("a", 1.0, "x")], [("a", 2.0, "y")], [("a", 1.0, "z")], [("a", 1.0, "z")]]
    h = None
    for n in (0, 3, 2, 1, 1, 2):
        h = scd2_timeline.merge_at(h, spark.createDataFrame(one[n], SNAP), SPEC, days[n])
        h = spark.createDataFrame(h.collect(), h.schema)
    got = as_rows(h.select("k", "price", "effective_date", "end_date", "is_current", "observed_on"))
    assert got == timeline(list(zip(days, one)))
    # a snapshot that repeats a date with another value takes its place
    h = scd2_timeline.merge_at(h, spark.createDataFrame([("a", 1.0, "w")], SNAP), SPEC, days[1])
    assert [(r.effective_date, r.end_date, len(r.observed_on)) for r in h.collect()] == [(days[0], None, 4)]


def test_null_keys_and_new_items(spark):
    h = scd2_timeline.merge_at(None, spark.createDataFrame([(None, 1.0, ""), ("a", 1.0, "")], SNAP), SPEC, date(2024, 1, 5))
    h = scd2_timeline.merge_at(h, spark.createDataFrame([(None, 1.0, ""), ("b", 3.0, "")], SNAP), SPEC, date(2024, 1, 1))
    assert sorted((r.k, r.effective_date.day, r.is_current) for r in h.collect()) == [("a", 5, True), ("b", 1, True)]


# --- as of -----------------------------------------------------------------------------------

def plainly(left, right, how="left"):
    out = []
    for n, k, t in left:
        fits = [(rt, v) for rk, rt, v in right if rk is not None and rk == k and rt is not None and t is not None and rt <= t]
        best = max(fits, default=(None, None))
        if how == "left" or fits:
            out.append((n, k, t, *best))
    return sorted(out, key=repr)


@pytest.mark.parametrize("days,how", [(1, "left"), (7, "inner"), (1000, "left")])
def test_asof_join(spark, days, how):
    rnd = random.Random(9)
    day = lambda: date(2024, 1, 1) + timedelta(rnd.randint(0, 90))
    left = [(n, rnd.choice(["a", "b", "hot", "hot", None, "none"]), None if rnd.random() < 0.03 else day()) for n in range(600)]
    right = [(rnd.choice(["a", "b", "hot", None, "only"]), None if rnd.random() < 0.05 else day(), rnd.randint(0, 9)) for _ in range(60)]
    got = asof.asof_join(spark.createDataFrame(left, "n long, k string, t date"), spark.createDataFrame(right, "k string, rt date, v long"),
                         ["k"], "t", "rt", ["v"], how, range_days=days)
    assert as_rows(got) == plainly(left, right, how)


def test_a_hot_key_is_cut_by_range(spark):
    left = spark.range(5000).select(F.lit("hot").alias("k"), F.expr("date_add(DATE '2024-01-01', cast(id % 320 as int))").alias("t"))
    right = spark.createDataFrame([("hot", date(2023, 5, 1), 1), ("hot", date(2024, 6, 1), 2)], "k string, rt date, v long")
    out = asof.asof_join(left, right, ["k"], "t", "rt", ["v"], range_days=16)
    assert {(r.v, r["count"]) for r in out.groupBy("v").count().collect()} == {
        (1, left.filter("t < '2024-06-01'").count()), (2, left.filter("t >= '2024-06-01'").count())}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "__asof_range" in plan and "SinglePartition" not in plan


def test_star_at_respects_ends(spark):
    h = spark.createDataFrame([("a", 1.0, date(2024, 1, 1), date(2024, 2, 1), False), ("a", 2.0, date(2024, 2, 1), None, True),
                               ("b", 9.0, date(2024, 1, 1), date(2024, 1, 5), False)],
                              "k string, price double, effective_date date, end_date date, is_current boolean")
    fact = spark.createDataFrame([("a", date(2023, 1, 1)), ("a", date(2024, 1, 31)), ("a", date(2024, 2, 1)), ("b", date(2024, 1, 5))], "k string, t date")
    got = [(r.k, r.t, r.price) for r in asof.star_at(fact, h, SPEC, "t", ["price"]).orderBy("k", "t").collect()]
    assert [g[2] for g in got] == [None, 1.0, 2.0, None]
