"""Materialized stages: one computation, observed counts, under the checkpoint folder."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.rank import with_percentiles
from strata.session import checkpoint_dir, materialize_counted


def test_materialize_counted(spark):
    df, n = materialize_counted(spark.range(0, 1234).withColumn("x", F.col("id") * 2), "t")
    assert n == 1234 and df.count() == 1234
    def path(uri):
        return uri.split(":", 1)[-1].lstrip("/")
    assert path(df.inputFiles()[0]).startswith(path(checkpoint_dir(spark)))


def test_percentiles_equal_a_window(spark):
    df = spark.createDataFrame([(f"i{i % 37}", float(i % 11), i) for i in range(500)],
                               "n string, p double, id long")
    w = Window.orderBy(F.col("p").desc_nulls_last(), "n", "id")
    want = df.select("id", F.round(F.row_number().over(w) / 500 * 100, 0).cast("int").alias("pct"))
    got = with_percentiles(df, ["n", "id"], {"pct": ("p", True)}, partitions=3)
    assert sorted(tuple(r) for r in want.collect()) == sorted(tuple(r) for r in got.select("id", "pct").collect())


def test_scratch_scope_drops_its_stages(spark):
    from strata.session import materialize, scratch_scope
    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        inner = materialize(spark.range(5), "inner")
        assert inner.count() == 5
        name = inner.inputFiles()[0]
    assert kept.count() == 3                        # outside the scope: untouched
    import os
    local = name.split(":", 1)[-1]
    while local.startswith("//"):
        local = local[1:]
    assert not os.path.exists(local)                # dropped with its files
