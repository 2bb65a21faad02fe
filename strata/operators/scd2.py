"""Type 2 slowly changing dimension: a pure DataFrame -> DataFrame merge.

Semantics (as the original, with the hazards it leaves open fixed):

* no history yet: every snapshot row becomes current, ``effective = as_of``,
  ``end = null``;
* key new to the current rows: inserted as current;
* key present and a tracked column differs (null-aware): the current row is
  closed (``end = as_of``, ``current = false``) and the snapshot row inserted;
* key present and unchanged: the existing row is kept as is (untracked columns
  are not refreshed);
* current key missing from the snapshot: kept current (``close_missing=True``
  closes it instead);
* closed rows: kept; a row whose current flag is null counts as closed and is
  kept (the original dropped it).

Plan: current history rows and the snapshot meet in ONE full outer join on the
business keys (two hash exchanges, no other shuffle); each key's outcome is a
flat ``CASE``, a changed key is duplicated by a two-element ``explode``, and
every output column is one ``when``; closed rows bypass the join through a
union, so the history is read twice, each row once. Rows with a null key never
match; a second join key spreads them over the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Outcome labels carried in ``__scd2_kind`` (observable counts).
NEW, CHANGED, EXPIRED, UNCHANGED, MISSING, CLOSED_MISSING, HISTORY = (
    "new", "changed", "expired", "unchanged", "missing", "closed_missing", "history")


@dataclass(frozen=True)
class Scd2Spec:
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    effective: str = "effective_date"
    end: str = "end_date"
    current: str = "is_current"

    def __post_init__(self):
        if not self.keys:
            raise ValueError("SCD2 needs at least one business key")
        if not self.tracked:
            raise ValueError("SCD2 needs at least one tracked column")
        overlap = set(self.keys) & set(self.tracked)
        if overlap:
            raise ValueError(f"columns both key and tracked: {sorted(overlap)}")

    @property
    def meta(self) -> list[str]:
        return [self.effective, self.end, self.current]


class DuplicateKeyError(ValueError):
    pass


def _is_current(spec: Scd2Spec) -> Column:
    return F.coalesce(F.col(spec.current), F.lit(False))


def _any_null(cols: Sequence[str]) -> Column:
    out = None
    for c in cols:
        t = F.col(c).isNull()
        out = t if out is None else (out | t)
    return out


def check_unique_keys(snapshot: DataFrame, keys: Sequence[str], sample: int = 5) -> None:
    """Raise ``DuplicateKeyError`` (with sample keys) if a non-null key repeats."""
    dup = (snapshot.filter(~_any_null(keys)).groupBy(*keys).count()
           .filter(F.col("count") > 1).limit(sample).collect())
    if dup:
        raise DuplicateKeyError(f"snapshot has duplicate business keys, e.g. "
                                f"{[tuple(r)[:-1] for r in dup]}")


def initial(snapshot: DataFrame, spec: Scd2Spec, as_of: date) -> DataFrame:
    """First load: every row current from ``as_of``."""
    return snapshot.select(
        *[F.col(c) for c in snapshot.columns if c not in spec.meta],
        F.lit(as_of).cast("date").alias(spec.effective),
        F.lit(None).cast("date").alias(spec.end),
        F.lit(True).alias(spec.current))


def change_predicate(tracked: Sequence[str], new_prefix: str, old_prefix: str) -> Column:
    """True when any tracked column differs, null-aware (null vs value is a change).

    Compares ``<new_prefix><c>`` with ``<old_prefix><c>`` for every tracked ``c``.
    """
    out = None
    for c in tracked:
        t = ~F.col(new_prefix + c).eqNullSafe(F.col(old_prefix + c))
        out = t if out is None else (out | t)
    return out


def merge(history: DataFrame, snapshot: DataFrame, spec: Scd2Spec, as_of: date, *,
          null_keys: str = "drop", close_missing: bool = False, validate: bool = True,
          observation: Observation | None = None) -> DataFrame:
    """Apply one snapshot to an SCD2 history; returns the whole new history.

    ``null_keys``: "drop" ignores snapshot rows with a null key (route them to
    quarantine before calling); "append" inserts them as new current rows on
    every load, as the original does. ``validate`` raises on duplicate snapshot
    keys (one aggregate job). ``observation`` collects per-outcome row counts
    when the result is written.
    """
    if null_keys not in ("drop", "append"):
        raise ValueError("null_keys must be 'drop' or 'append'")
    missing = [c for c in (*spec.keys, *spec.tracked) if c not in snapshot.columns]
    if missing:
        raise ValueError(f"snapshot lacks columns {missing}")
    if validate:
        check_unique_keys(snapshot, spec.keys)

    snap_cols = [c for c in snapshot.columns if c not in spec.meta]
    hist_types = dict(history.dtypes)
    snap_types = dict(snapshot.dtypes)
    extra = [c for c in history.columns if c not in snap_cols and c not in spec.meta]
    data_cols = snap_cols + extra
    types = {c: snap_types.get(c, hist_types.get(c)) for c in data_cols}
    eff, end, cur = spec.effective, spec.end, spec.current
    out_cols = data_cols + spec.meta
    day = F.lit(as_of).cast("date")
    kind = "__scd2_kind"

    def typed(c: str, have: dict) -> Column:
        """Column ``c`` in the merged type (a typed null where the side lacks it)."""
        if c not in have:
            return F.lit(None).cast(types[c])
        return F.col(c) if have[c] == types[c] else F.col(c).cast(types[c])

    def hist_cols(prefix: str = "") -> list[Column]:
        def meta(c: str) -> Column:
            return F.col(c) if hist_types.get(c) == "date" else F.col(c).cast("date")
        return ([typed(c, hist_types).alias(prefix + c) for c in data_cols]
                + [meta(eff).alias(prefix + eff), meta(end).alias(prefix + end),
                   _is_current(spec).alias(prefix + cur)])

    def snap_cols_as(prefix: str = "") -> list[Column]:
        return [typed(c, snap_types).alias(prefix + c) for c in data_cols]

    # Closed versions bypass the join: one pass over them, one over the current rows.
    # Rows with a null key match nothing; a second join key spreads them, so they do
    # not pile up in the one partition that nulls hash to.
    null_key = _any_null(spec.keys)
    past = history.filter(~_is_current(spec)).select(*hist_cols(), F.lit(HISTORY).alias(kind))

    def spread(cols: Sequence[str]) -> Column:
        return F.when(null_key, F.xxhash64(*[F.col(c) for c in cols])).otherwise(F.lit(0).cast("long"))

    snap = snapshot if null_keys == "append" else snapshot.filter(~null_key)
    s = snap.select(*snap_cols_as("__s_"), spread(snapshot.columns).alias("__s_at"), F.lit(True).alias("__s_in"))
    h = history.filter(_is_current(spec)).select(
        *hist_cols("__h_"), spread(history.columns).alias("__h_at"), null_key.alias("__h_null"),
        F.lit(True).alias("__h_in"))
    cond = F.col("__s_at") == F.col("__h_at")
    for k in spec.keys:
        cond = cond & (F.col(f"__s_{k}") == F.col(f"__h_{k}"))
    joined = s.join(h, cond, "full_outer")

    changed = change_predicate(spec.tracked, "__s_", "__h_")
    outcome = (F.when(F.col("__h_in").isNull(), F.lit(NEW))
               .when(F.col("__s_in").isNull() & F.col("__h_null"), F.lit(MISSING))
               .when(F.col("__s_in").isNull(),
                     F.lit(CLOSED_MISSING if close_missing else MISSING))
               .when(changed, F.lit(EXPIRED))
               .otherwise(F.lit(UNCHANGED)))
    # a changed key yields two rows: the closed old version and the new one
    classified = joined.withColumn("__o", outcome).withColumn(
        "__copy", F.explode(F.when(F.col("__o") == EXPIRED, F.array(F.lit(0), F.lit(1)))
                            .otherwise(F.array(F.lit(0)))))
    o, copy = F.col("__o"), F.col("__copy")
    take_snap = (o == NEW) | ((o == EXPIRED) & (copy == 1))
    closing = ((o == EXPIRED) & (copy == 0)) | (o == CLOSED_MISSING)
    merged = classified.select(
        *[F.when(take_snap, F.col(f"__s_{c}")).otherwise(F.col(f"__h_{c}")).alias(c)
          for c in data_cols],
        F.when(take_snap, day).otherwise(F.col(f"__h_{eff}")).alias(eff),
        F.when(take_snap, F.lit(None).cast("date")).when(closing, day)
        .otherwise(F.col(f"__h_{end}")).alias(end),
        F.when(take_snap, F.lit(True)).when(closing, F.lit(False))
        .otherwise(F.col(f"__h_{cur}")).alias(cur),
        F.when((o == EXPIRED) & (copy == 1), F.lit(CHANGED)).otherwise(o).alias(kind))

    result = past.unionByName(merged)
    if observation is not None:
        result = result.observe(observation, *[
            F.count_if(F.col(kind) == k).alias(k)
            for k in (NEW, CHANGED, EXPIRED, UNCHANGED, MISSING, CLOSED_MISSING, HISTORY)],
            F.count(F.lit(1)).alias("total"))
    return result.select(*out_cols)


def apply(history: DataFrame | None, snapshot: DataFrame, spec: Scd2Spec, as_of: date, *,
          enabled: bool = True, **kw) -> DataFrame:
    """Switch: plain replace when SCD2 is off, first load when there is no history."""
    if not enabled:
        return snapshot
    if history is None:
        if kw.get("validate", True):
            check_unique_keys(snapshot, spec.keys)
        if kw.get("null_keys", "drop") == "drop":
            snapshot = snapshot.filter(~_any_null(spec.keys))
        return initial(snapshot, spec, as_of)
    return merge(history, snapshot, spec, as_of, **kw)


def version_key(spec: Scd2Spec, name: str = "version_key") -> Column:
    """A key per version (business key + effective date), for facts that must
    point at the version valid when they happened rather than at the item."""
    from ..functions.keys import composite_key
    return composite_key(*spec.keys, F.col(spec.effective).cast("string")).alias(name)


# --- read-side views of a history ---------------------------------------------------

def current_view(history: DataFrame, spec: Scd2Spec) -> DataFrame:
    return history.filter(_is_current(spec))


def closed_versions(history: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Closed versions only (the 'history' table of the configuration)."""
    return history.filter(~_is_current(spec))


def as_of_view(history: DataFrame, spec: Scd2Spec, when: date) -> DataFrame:
    """Versions valid at ``when``: ``effective <= when < end`` (open end = still valid)."""
    d = F.lit(when).cast("date")
    return history.filter((F.col(spec.effective) <= d)
                          & (F.col(spec.end).isNull() | (F.col(spec.end) > d)))


def versions(history: DataFrame, spec: Scd2Spec, min_versions: int = 1,
             keys: Sequence | None = None) -> DataFrame:
    """All versions with ``version_number`` (1 = newest) and ``version_count`` per key.

    The window is partitioned by the business key, so a partition holds one
    key's versions only.
    """
    from pyspark.sql import Window
    df = history
    if keys is not None:
        if len(spec.keys) != 1:
            raise ValueError("key lookup by value needs a single business key")
        df = df.filter(F.col(spec.keys[0]).isin(list(keys)))
    w = Window.partitionBy(*spec.keys)
    newest = [F.col(spec.effective).desc_nulls_last(), F.col(spec.end).desc_nulls_first(),
              _is_current(spec).desc()]
    out = (df.withColumn("version_number", F.row_number().over(w.orderBy(*newest)))
           .withColumn("version_count", F.count(F.lit(1)).over(w)))
    if min_versions > 1:
        out = out.filter(F.col("version_count") >= min_versions)
    if keys is not None:            # a lookup reads newest first
        out = out.orderBy(*spec.keys, "version_number")
    return out


def health(history: DataFrame, spec: Scd2Spec) -> DataFrame:
    """One row: total rows, current rows, distinct business keys."""
    return history.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(_is_current(spec)).alias("current_records"),
        F.count_distinct(*[F.col(k) for k in spec.keys]).alias("unique_keys"))
