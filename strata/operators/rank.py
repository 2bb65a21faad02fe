"""Ranking operators: per-group ranks, best-per-group, top-n and a distributed global position.

Plan notes
----------
* ``dense_ranks`` and ``with_percentiles`` sort narrow (ordering, key, value)
  rows of all their orderings in one range sort and join the result back, the
  same plan at every size: no window without a partition, no group in one task.
* ``best`` is an aggregate expression (``min_by`` over an ordering struct), so a
  hot group is combined map-side like any sum; there is no window and no join.
* ``top_n`` filters a rank computed in the same plan, which Spark turns into a
  ``WindowGroupLimit`` that keeps at most n rows per group before the shuffle.
* ``global_position`` replaces ``row_number() over (order by ...)`` -- a window
  with no partition, which Spark runs in a single task -- by a range-partitioned
  sort: Spark samples the full ordering (ties included) to cut ranges, so no
  value, however frequent, pins the work to one task. The sorted ranges are
  written as parquet files under the session's checkpoint folder, fixing
  their order; per-file row counts (one row per file) are the only data
  brought to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import percentile_of
from ..session import write_stage


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def desc_nulls_last(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def _null_safe_eq(pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for a, b in pairs:
        t = F.col(a).eqNullSafe(F.col(b))
        cond = t if cond is None else (cond & t)
    return cond


def dense_ranks(df: DataFrame, by: Sequence[str], rankings: Mapping[str, str],
                partitions: int | None = None) -> DataFrame:
    """Add one dense rank per entry of ``rankings`` (output name -> column, best = highest,
    nulls last), computed within the groups ``by``, with no group confined to one task.

    The distinct (ranking, group, value) triples of all rankings get one
    whole-table position (``global_position``: one range sort whatever the
    number of rankings); a value's dense rank is its position minus the first
    position of its ranking and group, plus one. Ranks join back on (group,
    value), null-safe; a hot pair is split by AQE's skew join. The ranked
    columns must share a type. ``df`` is read several times: pass a written stage.
    """
    kinds = {df.schema[c].dataType.simpleString() for c in rankings.values()}
    if len(kinds) > 1:
        raise ValueError(f"ranked columns must share a type, not {sorted(kinds)}")
    group = [f"__g{i}" for i in range(len(by))]
    narrow = None
    for k, c in enumerate(rankings.values()):
        part = df.select(F.lit(k).alias("__k"), *[F.col(b).alias(g) for b, g in zip(by, group)],
                         F.col(c).alias("__v"))
        narrow = part if narrow is None else narrow.unionByName(part)
    order = [F.col("__k").asc(), *[F.col(g).asc_nulls_first() for g in group],
             F.col("__v").desc_nulls_last()]
    pos = global_position(narrow.distinct(), order, position="__p", total=None, partitions=partitions)
    keys = ["__k", *group]
    first = pos.groupBy(*keys).agg(F.min("__p").alias("__s")).select(
        *[F.col(c).alias(f"{c}f") for c in keys], "__s")
    ranked = (pos.join(first, _null_safe_eq([(c, f"{c}f") for c in keys]))
              .select(*keys, "__v", (F.col("__p") - F.col("__s") + 1).cast("int").alias("__r")))
    out = df
    for k, (name, c) in enumerate(rankings.items()):
        own = ranked.filter(F.col("__k") == k).select(*group, "__v", F.col("__r").alias(name))
        out = (out.join(own, _null_safe_eq([*zip(by, group), (c, "__v")]))
               .drop(*group, "__v"))
    return out


def best(item: str, measure: str, descending: bool = True) -> Column:
    """Aggregate: the item with the best measure in the group, ties by item ascending.

    Rows with a null measure rank last, so an all-null group still yields an item.
    ``measure`` must be numeric (it is negated for the descending order). Its
    ordering struct is not fixed-width, so Spark aggregates it by sorting: use
    it on pre-aggregated frames, or ``best_per_group`` on fact-sized ones.
    """
    m = F.col(measure)
    key = F.struct(m.isNull().alias("m_null"), (-m if descending else m).alias("m"),
                   F.col(item).alias("i"))
    return F.min_by(F.col(item), key)


def best_per_group(df: DataFrame, by: Sequence[str], item: str, measure: str,
                   descending: bool = True, out: str = "best") -> DataFrame:
    """One row per group with its best item (as ``best``), in two aggregates.

    The first keeps each item's best measure with a hash aggregate (map-side
    combined, so a hot group ships one partial row per item and task); only
    that small result is ordered by ``best``.
    """
    agg = F.max if descending else F.min
    per_item = df.groupBy(*by, item).agg(agg(measure).alias("__m"))
    return per_item.groupBy(*by).agg(best(item, "__m", descending).alias(out))


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int,
          kind: str = "row_number", rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order``.

    ``order`` must be a total order for ``row_number`` to be repeatable.
    """
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[kind]
    name = rank_col or "__rank"
    w = Window.partitionBy(*by).orderBy(*_cols(order)) if by else Window.orderBy(*_cols(order))
    out = df.withColumn(name, fn().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


_PART_FILE = re.compile(r"^part-(\d+)-.*?(?:-c(\d+))?(?:\..*)?$")


def _file_order(name: str) -> tuple:
    """Sort key of a written file: task number, then its file counter (c000, c001, ...)."""
    m = _PART_FILE.match(name)
    if not m:
        return (float("inf"), 0, name)
    return (int(m.group(1)), int(m.group(2) or 0), name)


def global_position(df: DataFrame, order: Sequence[Column | str], position: str = "position",
                    total: str | None = "total", partitions: int | None = None) -> DataFrame:
    """1-based position of every row in a whole-table order (and the row count).

    Equal to ``row_number() over (order by <order>)``; give a total order
    (tie-break columns last) for repeatable positions.

    The rows are range-partitioned on the full ordering (Spark samples it, so
    a frequent value is split by its tie-break columns) and written sorted as
    parquet under the checkpoint folder: file i holds range i in order. A
    row's position is the row count of the files before its own plus its
    ``_metadata.row_index`` in the file. The plan of ``df`` runs twice (sampling,
    write): pass a scan or a written stage. One row for each written file, of
    which there are ``partitions``, reaches the driver; the offsets go back as
    a table that Spark joins by its size.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordering = _cols(order)
    frozen = spark.table(write_stage(df.repartitionByRange(n, *ordering)
                                     .sortWithinPartitions(*ordering), "position"))
    tagged = frozen.select("*", F.col("_metadata.file_name").alias("__file"),
                           F.col("_metadata.row_index").alias("__row"))
    counts = sorted(((_file_order(r[0]), r[0], r[1]) for r in
                     tagged.groupBy("__file").count().collect()))
    offsets, acc = [], 0
    for _, name, cnt in counts:
        offsets.append((name, acc))
        acc += cnt
    starts = spark.createDataFrame(offsets, "__file string, __offset long")
    out = (tagged.join(starts, "__file")
           .withColumn(position, (F.col("__offset") + F.col("__row") + 1).cast("long")))
    if total:
        out = out.withColumn(total, F.lit(acc).cast("long"))
    return out.drop("__file", "__row", "__offset")


def with_percentiles(df: DataFrame, key: Sequence[str], specs: Mapping[str, tuple[str, bool]],
                     partitions: int | None = None) -> DataFrame:
    """Add ``int(round(position / total * 100))`` columns, one per ordering.

    ``specs`` maps output column -> (numeric column, descending); position 1 is
    the first row; ascending puts nulls first, descending last; ties go by
    ``key``, which names each row once. All orderings share one range sort of
    narrow (ordering, value, key) rows, whose positions join back on the key.
    ``df`` is read several times: pass a written stage.
    """
    names = [f"__c{i}" for i in range(len(key))]
    keyed = [F.col(c).alias(n) for c, n in zip(key, names)]
    narrow = None
    for k, (c, descending) in enumerate(specs.values()):
        v = F.col(c).cast("double")
        first = (F.when(v.isNull(), 2).when(F.isnan(v), 0).otherwise(1) if descending
                 else F.when(v.isNull(), 0).otherwise(1))
        part = df.select(F.lit(k).alias("__k"), first.alias("__f"), (-v if descending else v).alias("__v"),
                         *keyed)
        narrow = part if narrow is None else narrow.unionByName(part)
    order = ["__k", "__f", F.col("__v").asc_nulls_first(), *[F.col(n).asc_nulls_first() for n in names]]
    pos = global_position(narrow, order, position="__p", total="__t", partitions=partitions)
    rows = F.col("__t") / len(specs)         # every ordering holds every row
    ranked = (pos.withColumn("__p", F.col("__p") - F.col("__k") * rows)
              .groupBy(*names)
              .agg(*[F.max(F.when(F.col("__k") == k, percentile_of("__p", rows))).alias(name)
                     for k, name in enumerate(specs)]))
    return df.join(ranked, _null_safe_eq(list(zip(key, names)))).drop(*names)
