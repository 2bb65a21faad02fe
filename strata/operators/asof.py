"""As-of join: each left row with the latest right row of its key at or before its time.

Both sides are united and scanned once in the order of time by a window per key: the last
right row seen so far is the match. No pair of rows is ever formed, so a key with many rows on
both sides costs their sum.

A key that holds a third of the rows would be one window in one task. Time is therefore cut into
ranges of ``range_days``, and the window runs per (key, range). What a range needs from earlier
ones is one row: the last right row before it, found by a maximum per (key, range) and a scan over a key's
ranges, which are as many as the time span has, whatever the key's rows.

Ties: a right row of the same time counts as at or before. Of right rows equal in key and time the one
with the greatest values (compared column by column) is taken. Left rows without a match have nulls (or are left out with
``how="inner"``); a null key or time matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_DAYS = 32


def _range(time: str, days: int) -> Column:
    return F.floor(F.datediff(F.col(time).cast("date"), F.lit("1970-01-01").cast("date")) / days)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, right_time: str,
              values: Sequence[str], how: str = "left", range_days: int = RANGE_DAYS) -> DataFrame:
    """``left`` with ``values`` and ``right_time`` of the matching right row.

    ``keys`` are the same on both sides, ``time`` and ``right_time`` dates or timestamps of one type.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    values = [right_time, *(v for v in values if v != right_time)]
    clash = [v for v in values if v in left.columns] + [c for c in left.columns if c.startswith("__asof")]
    if clash:
        raise ValueError(f"columns are on both sides: {clash}")
    keys = list(keys)
    known = right.dropna(subset=[*keys, right_time]).select(
        *keys, F.col(right_time).alias("__asof_t"), _range(right_time, range_days).alias("__asof_range"),
        F.struct(*values).alias("__asof_v"))
    rows = left.select(*keys, F.col(time).alias("__asof_t"), _range(time, range_days).alias("__asof_range"),
                       F.struct(*left.columns).alias("__asof_l"))
    whole = F.lit(True)
    for k in [*keys, "__asof_t"]:
        whole = whole & F.col(k).isNotNull()
    # what each range of a key begins with: the last right row before it
    last = known.groupBy(*keys, "__asof_range").agg(F.max(F.struct("__asof_t", "__asof_v")).alias("last"))
    used = (rows.filter(whole).select(*keys, "__asof_range").distinct()
            .join(last, [*keys, "__asof_range"], "full_outer"))
    earlier = Window.partitionBy(*keys).orderBy("__asof_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (used.withColumn("carry", F.last("last", ignorenulls=True).over(earlier)).filter(F.col("carry").isNotNull())
               .select(*keys, "__asof_range", F.col("carry.__asof_t").alias("__asof_t"), F.col("carry.__asof_v").alias("__asof_v")))
    none = F.lit(None).cast(rows.schema["__asof_l"].dataType)
    united = (rows.filter(whole).withColumn("__asof_v", F.lit(None).cast(known.schema["__asof_v"].dataType))
              .unionByName(known.unionByName(carried).withColumn("__asof_l", none)))
    # at one time right rows come first, in the order of their values
    scan = (Window.partitionBy(*keys, "__asof_range")
            .orderBy("__asof_t", F.col("__asof_l").isNotNull(), "__asof_v")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (united.withColumn("__asof_m", F.last("__asof_v", ignorenulls=True).over(scan))
             .filter(F.col("__asof_l").isNotNull()).select("__asof_l", "__asof_m"))
    lost = rows.filter(~whole).select("__asof_l", F.lit(None).cast(known.schema["__asof_v"].dataType).alias("__asof_m"))
    out = found.unionByName(lost)
    if how == "inner":
        out = out.filter(F.col("__asof_m").isNotNull())
    return out.select(*(F.col("__asof_l").getField(c).alias(c) for c in left.columns),
                      *(F.col("__asof_m").getField(v).alias(v) for v in values))


def star_at(fact: DataFrame, history: DataFrame, spec, time: str, values: Sequence[str]) -> DataFrame:
    """Facts with the item version valid at their time: ``effective <= time < end``.

    The fact's keys are called like the history's. A version that had ended by then gives nulls.
    """
    dated = history.withColumn("__valid_from", F.col(spec.effective).cast(fact.schema[time].dataType))
    own = [spec.effective, spec.end, *values]
    out = asof_join(fact, dated, spec.keys, time, "__valid_from", own)
    ended = F.coalesce(F.col(spec.end) <= F.col(time), F.lit(False))
    return out.select(*fact.columns, *(F.when(~ended, F.col(v)).alias(v) for v in own))
