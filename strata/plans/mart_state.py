"""Marts kept up to date by what a load changes, instead of a rebuild from all facts.

State. The fact's partial aggregate (by item and group, ``marts.fact_partials``) is kept per load, as one
partition of a table. A load's facts are read once, when it arrives; to retract a load, or to replace it by a
corrected one, its partition is dropped or overwritten. Parts add up, so the sum of all partitions is the
partial of the whole fact: minima, maxima and exact sums included, as nothing is ever subtracted.

Ranking and summary. Both belong to groups. After a load the groups it touched are those with facts in
its old or new partition, and those with facts of items or groups whose dimension rows differ from the ones the marts were
built with. Only they are computed anew. A mart is partitioned by a hash of the group's key, and a refresh overwrites
the partitions of touched groups alone: the other groups of such a partition keep their rows as they are.

The value mart's percentiles are positions in the whole table; it is rebuilt from the state, not from the facts.

Restart: every step overwrites whole partitions with what depends on the state and the dimensions only. ``refresh`` asks
for the touched groups; after a failure it is run again with the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import marts
from .marts import MartSpec

LOAD, SLICE = "load", "slice"
SLICES = 64


def _overwrite(df: DataFrame, folder: str, by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


#: what of a fact enters its partial aggregate
_FACT = ("drug_key string, condition_key string, effectiveness_score double, ease_of_use_score double, "
         "satisfaction_score double, review_count int, price double")


def _state(spark: SparkSession, folder: str) -> DataFrame:
    """The partials of all loads; no rows if every load has been retracted."""
    schema = marts.fact_partials(spark.createDataFrame([], _FACT)).withColumn(LOAD, F.lit("")).schema
    return spark.read.schema(schema).parquet(folder)


def _load_of(spark: SparkSession, folder: str, load: str) -> DataFrame | None:
    if not _exists(spark, f"{folder}/{LOAD}={load}"):
        return None
    return _state(spark, folder).filter(F.col(LOAD) == load).drop(LOAD)


def put_load(fact: DataFrame, folder: str, load: str) -> DataFrame:
    """Add or replace a load's facts; returns the keys of the groups it touches."""
    spark = fact.sparkSession
    if not load.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a load's name is made of letters, digits, - and _")
    old = _load_of(spark, folder, load)
    touched = None
    if old is not None:
        touched = materialize(old.select("condition_key").distinct(), "touched")
        if not touched.isEmpty():                      # facts may be fewer now: an empty load leaves no partition to overwrite
            _drop(spark, folder, load)
    _overwrite(marts.fact_partials(fact).withColumn(LOAD, F.lit(load)), folder, LOAD)
    new = _state(spark, folder).filter(F.col(LOAD) == load).select("condition_key").distinct()
    return new if touched is None else new.unionByName(touched).distinct()


def _drop(spark: SparkSession, folder: str, load: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{LOAD}={load}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def retract_load(spark: SparkSession, folder: str, load: str) -> DataFrame:
    """Take a load's facts out again; returns the keys of the groups it touched."""
    touched = materialize(_state(spark, folder).filter(F.col(LOAD) == load).select("condition_key").distinct(), "touched")
    _drop(spark, folder, load)
    return touched


def partials(spark: SparkSession, folder: str) -> DataFrame:
    """The partial aggregate of all loads."""
    return marts.merged_partials(_state(spark, folder).drop(LOAD))


def groups_of_changed(spark: SparkSession, folder: str, before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Keys of the groups that have facts of dimension rows which differ between ``before`` and ``now`` (matched on ``key``)."""
    columns = [c for c in now.columns if c in before.columns]
    changed = (now.select(*columns).exceptAll(before.select(*columns)).unionByName(before.select(*columns).exceptAll(now.select(*columns)))
               .select(key).distinct())
    return _state(spark, folder).select("drug_key", "condition_key").distinct().join(changed, key, "left_semi").select("condition_key").distinct()


def base(spark: SparkSession, folder: str, items: DataFrame, groups: DataFrame) -> DataFrame:
    return marts.base_of_partials(partials(spark, folder), items, groups)


def refresh(spark: SparkSession, folder: str, mart: str, items: DataFrame, groups: DataFrame, touched: DataFrame,
            build, spec: MartSpec = MartSpec()) -> DataFrame:
    """Bring the mart in folder ``mart`` up to date for the ``touched`` groups (condition_key); returns the mart.

    ``build`` is ``marts.ranking`` or ``marts.summary``. Without a mart yet, all groups are built.
    """
    place = F.pmod(F.xxhash64("condition_name"), F.lit(SLICES)).cast("int")
    # names of touched groups, by the dimension as it is and, for groups that are gone, nothing: their rows go with their name
    if not _exists(spark, mart):
        new = build(materialize(base(spark, folder, items, groups), "mart_base"), spec, from_base=True)
        _overwrite(new.withColumn(SLICE, place), mart, SLICE)
        return spark.read.parquet(mart).drop(SLICE)
    touched = materialize(touched.distinct(), "touched")
    few = partials(spark, folder).join(touched, "condition_key", "left_semi")
    own = marts.base_of_partials(few, items, groups)
    names = touched.join(groups.select("condition_key", "condition_name"), "condition_key").select("condition_name").distinct()
    new = materialize(build(materialize(own, "mart_base"), spec, from_base=True).withColumn(SLICE, place), "mart_new")
    names = materialize(names.withColumn(SLICE, place), "mart_names")
    old = spark.read.schema(new.schema).parquet(mart)
    slices = [r[0] for r in names.select(SLICE).distinct().collect()]            # at most SLICES numbers
    kept = (old.filter(F.col(SLICE).isin(slices)).join(names.select("condition_name"), "condition_name", "left_anti").select(*new.columns))
    both = materialize(kept.unionByName(new), "mart_slices")
    _overwrite(both, mart, SLICE)
    left = {r[0] for r in both.select(SLICE).distinct().collect()}
    for gone in set(slices) - left:                                                # all their groups are gone
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{mart}/{SLICE}={gone}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return spark.read.schema(new.schema).parquet(mart).drop(SLICE)
