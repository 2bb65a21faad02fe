"""Ranks (W1-W5, R4) and their plan shapes."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.rank import best, dense_ranks, global_position, top_n, with_percentiles


def plan(df):
    """Physical plan as planned (call before any action: AQE then also prints the final plan)."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_position_equals_row_number(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([None, 1.0, 2.0, 2.0, 3.5]), f"n{rnd.randint(0, 50)}")
            for i in range(3000)]
    df = spark.createDataFrame(data, "id long, v double, name string")
    order = [F.col("v").desc_nulls_last(), F.col("name").asc(), F.col("id").asc()]
    got = global_position(df, order, partitions=6).select("id", "position", "total")
    assert "SinglePartition" not in plan(got)
    want = df.select("id", F.row_number().over(Window.orderBy(*order)).alias("position"))
    g = {r["id"]: (r["position"], r["total"]) for r in got.collect()}
    w = {r["id"]: r["position"] for r in want.collect()}
    assert all(g[k] == (w[k], 3000) for k in w)


def test_global_position_heavy_value_spreads(spark):
    # one value holds most rows; ties are split by the tie-break key, not pinned to one task
    df = spark.range(0, 4000).withColumn("v", F.when(F.col("id") % 10 == 0, F.col("id"))
                                         .otherwise(F.lit(7)))
    out = global_position(df, [F.col("v"), F.col("id")], partitions=4)
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2500
    pos = [r["position"] for r in out.orderBy("position").collect()]
    assert pos == list(range(1, 4001))


def test_percentiles(spark):
    df = spark.createDataFrame([(f"i{i}", float(i), None if i == 3 else -float(i)) for i in range(1, 9)],
                               "n string, p double, q double")
    out = with_percentiles(df, ["n"], {"pct": ("p", False), "back": ("q", True)})
    got = {r["n"]: (r["pct"], r["back"]) for r in out.collect()}
    assert got["i1"] == (13, 13) and got["i4"] == (50, 38) and got["i8"] == (100, 88) and got["i3"] == (38, 100)


def test_dense_ranks_equal_windows(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["g1", "g1", "g1", "g2", None]), rnd.choice([None, 1.0, 2.0, 3.0, 4.5, float("nan")]),
             rnd.choice([None, 7.0, 8.0]), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, x double, y double, id long")
    want = df
    for name, c in (("rx", "x"), ("ry", "y")):
        want = want.withColumn(name, F.dense_rank().over(
            Window.partitionBy("g").orderBy(F.col(c).desc_nulls_last())))
    out = dense_ranks(df, ["g"], {"rx": "x", "ry": "y"}, partitions=5)
    assert "Window" not in plan(out)
    assert sorted(tuple(r) for r in out.select("id", "rx", "ry").collect()) == \
        sorted(tuple(r) for r in want.select("id", "rx", "ry").collect())


def test_best_in_aggregate(spark):
    df = spark.createDataFrame([("g", "b", 5.0), ("g", "a", 5.0), ("g", "c", 1.0),
                                ("h", "z", None), ("h", "y", None)], "g string, i string, m double")
    out = df.groupBy("g").agg(best("i", "m").alias("b"))
    assert "Window" not in plan(out)
    assert {r["g"]: r["b"] for r in out.collect()} == {"g": "a", "h": "y"}


def test_top_n_uses_group_limit(spark):
    df = spark.range(0, 100).withColumn("g", F.col("id") % 3)
    out = top_n(df, ["g"], [F.col("id").desc()], 2)
    assert "WindowGroupLimit" in plan(out)
    assert sorted(r["id"] for r in out.collect()) == [94, 95, 96, 97, 98, 99]


def test_best_per_group_two_level(spark):
    from strata.operators.rank import best_per_group
    df = spark.createDataFrame([("g", "b", 5.0), ("g", "a", 5.0), ("g", "c", 1.0),
                                ("h", "z", None), ("h", "y", None), ("g", "c", 9.0)],
                               "g string, i string, m double")
    out = best_per_group(df, ["g"], "i", "m")
    assert {r["g"]: r["best"] for r in out.collect()} == {"g": "c", "h": "y"}


def test_rank_edge_inputs(spark):
    """FIXTURES rank_in: empty, one row, all equal, 30% nulls, many ties."""
    schema = "g string, v double, id long"
    cases = {
        "empty": [],
        "one": [("g", 1.0, 0)],
        "equal": [("g", 2.0, i) for i in range(50)],
        "nulls": [("g", None if i % 10 < 3 else float(i % 7), i) for i in range(200)],
        "ties": [("g", float(i % 50), i) for i in range(5000)],
    }
    for name, rows in cases.items():
        df = spark.createDataFrame(rows, schema)
        order = [F.col("v").desc_nulls_last(), F.col("id")]
        got = {r["id"]: r["position"] for r in
               global_position(df, order, partitions=3).select("id", "position").collect()}
        want = {r["id"]: r["p"] for r in
                df.select("id", F.row_number().over(Window.orderBy(*order)).alias("p")).collect()}
        assert got == want, name
        d = {r["id"]: r["r"] for r in
             dense_ranks(df, ["g"], {"r": "v"}, partitions=3).select("id", "r").collect()}
        w = {r["id"]: r["r"] for r in df.select("id", F.dense_rank().over(
            Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())).alias("r")).collect()}
        assert d == w, name
    empty = spark.createDataFrame([], schema)
    assert with_percentiles(empty, ["id"], {"p": ("v", False)}, partitions=2).count() == 0


def test_global_position_keeps_callers_cache(spark):
    df = spark.range(0, 100).cache()
    df.count()
    global_position(df, [F.col("id")], partitions=2).count()
    assert df.is_cached
    df.unpersist()
