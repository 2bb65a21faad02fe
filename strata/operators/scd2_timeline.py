"""Type 2 history from snapshots that arrive in any order, late or repeated.

``scd2.merge`` takes snapshots by date. A late one has to cut a version in two: what
was seen of an item before its date, the snapshot's values, and what was seen after. That
needs to be known, so a version carries ``observed_on``, the dates at which a snapshot
showed it (ascending; its first is the version's start).

Applying a snapshot of any date, per item:

* the version valid at that date has the same values: the date joins its observations;
* it has others, or there is none: the item's observations, with the snapshot's in the place
  of one of the same date, are cut again where values change. Neighbours with equal
  values become one version, a version seen on both sides of the date becomes two.

So the history depends on the set of snapshots only (for two of one date the later applied one
counts), not on their order; of columns that are not tracked, a version keeps what its
first observation known so far had. Items absent from a snapshot keep their version, as in ``merge``.

Plan: one join of the history with the snapshot by key, one window by key on its output (no second
exchange), and only disturbed items are cut again. An item's versions and dates are as many as
its loads, so no group grows with the data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scd2
from .scd2 import Scd2Spec, _any_null

OBSERVED = "observed_on"


def start(snapshot: DataFrame, spec: Scd2Spec, as_of: date) -> DataFrame:
    """The history after the first snapshot."""
    valid = snapshot.filter(~_any_null(spec.keys))
    return scd2.initial(valid, spec, as_of).withColumn(OBSERVED, F.array(F.lit(as_of).cast("date")))


def _same(spec: Scd2Spec, a: str, b: str) -> Column:
    return ~scd2.change_predicate(spec.tracked, a, b)


def _cut(observations: DataFrame, spec: Scd2Spec, data: list[str]) -> DataFrame:
    """Versions from (data, __on), one row an item and date."""
    by_date = Window.partitionBy(*spec.keys).orderBy("__on")
    marked = observations.select("*", *(F.lag(c).over(by_date).alias(f"__was_{c}") for c in spec.tracked),
                                 F.lag("__on").over(by_date).alias("__before"))
    starts = F.when(F.col("__before").isNull() | ~_same(spec, "", "__was_"), F.lit(1)).otherwise(F.lit(0))
    runs = marked.withColumn("__starts", starts).withColumn("__run", F.sum("__starts").over(by_date))
    rest = [c for c in data if c not in spec.keys]
    versions = runs.groupBy(*spec.keys, "__run").agg(
        *(F.min_by(F.struct(c), "__on").getField(c).alias(c) for c in rest),
        F.array_sort(F.collect_list("__on")).alias(OBSERVED))
    by_run = Window.partitionBy(*spec.keys).orderBy("__run")
    return (versions.withColumn(spec.effective, F.col(OBSERVED)[0])
            .withColumn(spec.end, F.lead(F.col(OBSERVED)[0]).over(by_run))
            .withColumn(spec.current, F.lead("__run").over(by_run).isNull()))


def merge_at(history: DataFrame | None, snapshot: DataFrame, spec: Scd2Spec, as_of: date,
             validate: bool = True) -> DataFrame:
    """The history with the snapshot of ``as_of``, whatever dates it already holds."""
    if validate:
        scd2.check_unique_keys(snapshot, spec.keys)
    if history is None:
        return start(snapshot, spec, as_of)
    missing = [c for c in history.columns if c not in (*snapshot.columns, *spec.meta, OBSERVED)]
    if missing:
        raise ValueError(f"snapshot lacks columns {missing}")
    data = [c for c in history.columns if c not in (*spec.meta, OBSERVED)]
    day = F.lit(as_of).cast("date")
    snap = snapshot.filter(~_any_null(spec.keys)).select(*spec.keys, F.lit(True).alias("__in"),
                                                         *(F.col(c).alias(f"__s_{c}") for c in data if c not in spec.keys))
    both = history.join(snap, list(spec.keys), "full_outer")
    covers = ((F.col(spec.effective) <= day)
              & (F.col(spec.end).isNull() | (F.col(spec.end) > day)))
    # a key's rows lie together after the join: the window needs no exchange
    by_key = Window.partitionBy(*spec.keys)
    fits = F.coalesce(covers & _same(spec, "__s_", ""), F.lit(False))
    judged = both.withColumn("__fits", fits).withColumn("__held", F.max("__fits").over(by_key))
    shown = F.coalesce("__in", F.lit(False))
    quiet = judged.filter(~shown | F.col("__held"))
    kept = quiet.withColumn(OBSERVED, F.when(shown & F.col("__fits"), F.array_sort(F.array_union(OBSERVED, F.array(day))))
                            .otherwise(F.col(OBSERVED)))
    disturbed = judged.filter(shown & ~F.col("__held"))
    old = (disturbed.filter(F.col(OBSERVED).isNotNull()).select(*data, F.explode(OBSERVED).alias("__on"))
           .filter(F.col("__on") != day))
    new = (disturbed.groupBy(*spec.keys).agg(F.first(F.struct(*(F.col(f"__s_{c}").alias(c) for c in data if c not in spec.keys))).alias("s"))
           .select(*spec.keys, *(F.col(f"s.{c}").alias(c) for c in data if c not in spec.keys), day.alias("__on")))
    cut = _cut(old.unionByName(new), spec, data)
    columns = [*data, *spec.meta, OBSERVED]
    return kept.select(*columns).unionByName(cut.select(*columns))
