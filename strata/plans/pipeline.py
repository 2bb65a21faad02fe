"""The three-stage pipeline: bronze (CSV ingest) -> silver (star, SCD2) -> gold (marts).

Each stage reads the tables the previous one wrote, replaces its own tables by
a staged swap (the SCD2 dimension: only the partitions a load changes), and appends
one audit row per written table. The run time and the SCD2 date are parameters (no clock
inside a plan), so a rerun with the same inputs and parameters writes the same rows. A run
ledger lets it go on after the last finished stage, and audit rows that the log holds already are not
appended again.

Rows that do not get through are kept and counted: CSV records the parser cannot
read (``<feed>_unreadable``), rows that fail a rule (``<feed>_quarantine``), facts that the
star join would drop (``<fact>_orphans``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..operators import quality, references, scd2, scd2_store
from ..operators.references import Reference
from ..session import materialize
from ..sources import csv, tables
from ..sources.contracts import contract
from ..sources.ledger import RunLedger, fingerprint
from ..sources.tables import SUCCESS, WARNING, AuditRow
from . import marts, star

LAYERS = ("landing", "bronze", "silver", "gold")
UNREADABLE, FAILS = "__unreadable", "__fails"
_FEEDS = [("drug_reviews_raw", "raw_reviews"), ("drug_reviews_clean", "clean_reviews")]


def ensure_databases(spark: SparkSession, cfg: PipelineConfig,
                     location_root: str | None = None) -> None:
    """One database per layer; under ``location_root`` when given (shared storage)."""
    for layer in LAYERS:
        db = cfg.database(layer)
        loc = f" LOCATION '{location_root}/{db}.db'" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def _audit(spark: SparkSession, cfg: PipelineConfig, rows: list[AuditRow]) -> None:
    tables.append_audit_once(spark, cfg.table("landing", "metadata_tracking"), rows)


def silver_rules() -> dict[str, Column]:
    """Rows without an item or a group name cannot be keyed: quarantine them."""
    def present(c: str) -> Column:
        return F.col(c).isNotNull() & (F.col(c) != "")
    return {"item_present": present("drug_clean"), "group_present": present("condition_clean")}


def run_bronze(spark: SparkSession, cfg: PipelineConfig, run_ts: datetime) -> dict[str, int]:
    out, audit = {}, []
    for key, file_key in _FEEDS:
        file_name = cfg.data_files[file_key]
        schema = contract(key)
        df, rep = csv.ingest(spark, f"{cfg.volume_path}/{file_name}", schema, run_ts,
                             multiline=cfg.multi_line.get(file_key, True),
                             errors_col="__errors", unreadable_col=UNREADABLE)
        # values that do not fit their type are counted, by column, in the same write
        typed = [f.name for f in schema.fields if f.name in rep.cast]
        seen = Observation(f"casts_{key}")
        counted = df.observe(seen, F.count_if(F.col(UNREADABLE).isNotNull()).alias(UNREADABLE), *[
            F.count_if(F.array_contains("__errors", c)).alias(c) for c in typed]).drop("__errors")
        if cfg.quarantine:
            counted = counted.filter(F.col(UNREADABLE).isNull())
        n = tables.replace_table(counted.drop(UNREADABLE), cfg.table("bronze", key), schema)
        if seen.get[UNREADABLE]:
            # rare, so the feed is read a second time for them instead of being written twice each load
            kept = df.filter(F.col(UNREADABLE).isNotNull()).select(
                "source_file", F.col(UNREADABLE).alias("record"), "ingestion_timestamp")
            n_bad = tables.replace_table(kept, f"{cfg.database('bronze')}.{key}_unreadable")
            audit.append(AuditRow(f"{key}_unreadable", file_name, n_bad, run_ts, "bronze", WARNING,
                                  "records the parser could not read" + ("" if cfg.quarantine else ", loaded as far as they go")))
        bad = {c: seen.get[c] for c in typed if seen.get[c]}
        out[key] = n
        notes = "; ".join(x for x in (rep.notes(), f"values that do not fit their type: {bad}" if bad else "") if x)
        audit.append(AuditRow(cfg.tables["bronze"][key], file_name, n, run_ts, "bronze",
                              WARNING if rep.schema_changed or bad else SUCCESS, notes or "loaded"))
    _audit(spark, cfg, audit)
    return out


def _cleansed(df: DataFrame, cfg: PipelineConfig, key: str, run_ts: datetime,
              audit: list[AuditRow], stage: str) -> DataFrame:
    """The rows of a cleansed feed that go on, from one written stage; the rules are judged and counted in that write."""
    if not cfg.quality_checks:
        return materialize(df, stage)
    rules, obs = silver_rules(), Observation(f"q_{key}")
    if not cfg.quarantine:
        # warn only: every row goes on, and the rows that fail a rule are counted
        kept = materialize(quality.observe(df, rules, obs), stage)
        failing = obs.get
        bad = {k: v for k, v in failing.items() if k.startswith("failed_") and v}
        audit.append(AuditRow(key, "bronze tables", failing["rows"], run_ts, "silver",
                              WARNING if bad else SUCCESS,
                              f"rows failing rules, kept: {bad}" if bad else "no row fails a rule"))
        return kept
    # the flag beside the list of rules is there for its file statistics: row groups without a failing row are not read
    flagged = quality.flag(quality.observe(df, rules, obs), rules).withColumn(FAILS, F.size(quality.FAILED) > 0)
    written = materialize(flagged, stage)
    bad = written.filter(F.col(FAILS)).drop(FAILS)
    qname = f"{cfg.database('silver')}.{key}_quarantine"
    n_bad = tables.replace_table(bad, qname)
    audit.append(AuditRow(f"{key}_quarantine", "bronze tables", n_bad, run_ts, "silver",
                          WARNING if n_bad else SUCCESS,
                          f"rows failing rules: {obs.get}" if n_bad else "no rows quarantined"))
    return written.filter(~F.col(FAILS)).drop(FAILS, quality.FAILED)


def run_silver(spark: SparkSession, cfg: PipelineConfig, run_ts: datetime,
               as_of: date) -> dict[str, int]:
    audit: list[AuditRow] = []
    raw = spark.table(cfg.table("bronze", "drug_reviews_raw"))
    clean = spark.table(cfg.table("bronze", "drug_reviews_clean"))
    # each feed is cleansed once; the dimensions and the fact read what is written here
    raw_c = _cleansed(star.cleanse_raw(raw), cfg, "drug_reviews_raw", run_ts, audit, "raw_cleansed")
    clean_c = _cleansed(star.cleanse_clean(clean), cfg, "drug_reviews_clean", run_ts, audit, "clean_cleansed")
    out: dict[str, int] = {}

    # item dimension, SCD2 when enabled AND tracked
    items = star.item_dimension(raw_c, clean_c)
    spec = cfg.scd2_spec("dim_drugs")
    dname = cfg.table("silver", "dim_drugs")
    buckets = (cfg.bucket_count, ["drug_key"]) if cfg.bucket_count > 0 else None
    note = "dimension with SCD2 tracking" if spec else "dimension (no SCD2)"
    status = SUCCESS
    if spec is None:
        out["dim_drugs"] = tables.replace_table(items, dname, bucket_by=buckets)
    else:
        tables.recover(spark, dname)
        before = scd2_store.adopt(spark, dname, spec, buckets)
        # item_dimension keeps one row per key by construction: no validation job
        outcome = scd2_store.load(items, dname, spec, as_of, validate=False, bucket_by=buckets,
                                  null_keys="drop" if cfg.quality_checks and cfg.quarantine else "append")
        dim = scd2_store.history(spark, dname, spec)
        tables.check(dim, contract("dim_drugs"))
        out["dim_drugs"] = dim.count()            # from the files' footers
    if spec is not None and before is not None:
        note += f"; outcomes {outcome}"
        diff = sorted((set(before) - set(spec.meta)) ^ set(items.columns))
        if diff:                    # the merge null-filled a changed schema
            status = WARNING
            note += f"; columns differ between history and snapshot: {diff}"
    audit.append(AuditRow(cfg.tables["silver"]["dim_drugs"], "bronze tables", out["dim_drugs"],
                          run_ts, "silver", status, note))
    if spec and "dim_drugs_history" in cfg.tables["silver"]:
        hname = cfg.table("silver", "dim_drugs_history")
        out["dim_drugs_history"] = tables.replace_table(
            scd2.closed_versions(scd2_store.history(spark, dname, spec), spec), hname)
        audit.append(AuditRow(cfg.tables["silver"]["dim_drugs_history"], "dim_drugs",
                              out["dim_drugs_history"], run_ts, "silver", SUCCESS,
                              "closed versions"))

    # group dimension, first-seen carried from the previous load
    gname = cfg.table("silver", "dim_conditions")
    tables.recover(spark, gname)
    prev = spark.table(gname) if tables.exists(spark, gname) else None
    groups = star.group_dimension(raw_c, clean_c, run_ts, previous=prev)
    out["dim_conditions"] = tables.replace_table(groups, gname, contract("dim_conditions"))
    audit.append(AuditRow(cfg.tables["silver"]["dim_conditions"], "bronze tables",
                          out["dim_conditions"], run_ts, "silver", SUCCESS, "dimension table"))

    fname = cfg.table("silver", "fact_drug_performance")
    facts, orphans = star.fact(raw_c, clean_c), None
    if cfg.quality_checks and cfg.quarantine:
        facts, orphans = references.split(facts, [
            Reference("drug_key", _items(spark, cfg), "drug_key", cfg.tables["silver"]["dim_drugs"]),
            Reference("condition_key", spark.table(gname), "condition_key", cfg.tables["silver"]["dim_conditions"])])
    out["fact_drug_performance"] = tables.replace_table(
        facts, fname, contract("fact_drug_performance"), bucket_by=buckets)
    dup = star.duplicate_keys(spark.table(fname), "performance_key").first()
    status, note = SUCCESS, "fact table"
    if dup["repeated_keys"]:
        status = WARNING
        note = (f"fact table; performance_key not unique: {dup['repeated_keys']} keys cover "
                f"{dup['rows_with_repeated_keys']} rows")
    audit.append(AuditRow(cfg.tables["silver"]["fact_drug_performance"], "bronze tables",
                          out["fact_drug_performance"], run_ts, "silver", status, note))
    if orphans is not None:
        oname = f"{cfg.tables['silver']['fact_drug_performance']}_orphans"
        n_bad = tables.replace_table(orphans, f"{cfg.database('silver')}.{oname}")
        counts = references.orphan_counts(spark.table(f"{cfg.database('silver')}.{oname}")) if n_bad else {}
        audit.append(AuditRow(oname, "bronze tables", n_bad, run_ts, "silver", WARNING if n_bad else SUCCESS,
                              f"facts without a dimension row: {counts}" if n_bad else "every fact has its dimension rows"))
    _audit(spark, cfg, audit)
    return out


def _items(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The item dimension's current rows."""
    name, spec = cfg.table("silver", "dim_drugs"), cfg.scd2_spec("dim_drugs")
    if spec is None:
        return spark.table(name)
    return scd2_store.current(spark, name, spec).drop(*spec.meta)


def gold_mart_spec(run_ts: datetime, **kw) -> marts.MartSpec:
    return marts.MartSpec(run_ts=run_ts, **kw)


def run_gold(spark: SparkSession, cfg: PipelineConfig, run_ts: datetime,
             spec: marts.MartSpec | None = None) -> dict[str, int]:
    base = marts.base_of_fact(spark.table(cfg.table("silver", "fact_drug_performance")), _items(spark, cfg),
                              spark.table(cfg.table("silver", "dim_conditions")))
    ranking, value, summary = marts.marts_of_base(materialize(base, "mart_base"),
                                                  spec or gold_mart_spec(run_ts))
    out, audit = {}, []
    for key, df, note in [("drug_effectiveness_ranking", ranking, "rankings by group"),
                          ("price_performance_analysis", value, "price vs performance"),
                          ("condition_treatment_summary", summary, "group treatment options")]:
        out[key] = tables.replace_table(df, cfg.table("gold", key), contract(key))
        audit.append(AuditRow(cfg.tables["gold"][key], "silver tables", out[key], run_ts, "gold",
                              SUCCESS, note))
    _audit(spark, cfg, audit)
    return out


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, run_ts: datetime, as_of: date,
                 location_root: str | None = None, resume: bool = True,
                 before: Callable[[str], None] | None = None) -> dict[str, dict[str, int]]:
    """Bronze, silver and gold in order, one session; returns rows written per table.

    A failing stage appends a ``failed`` audit row with the error, then re-raises. Run again with the
    same times and files, the pipeline goes on after the last finished stage; ``resume=False``
    runs all of them. ``before`` is called with each stage's name before it runs (a gate: what it raises
    fails the stage).
    """
    from ..session import scratch_scope
    ensure_databases(spark, cfg, location_root)
    with scratch_scope(spark):          # written stages are dropped once the run is done
        return _run_layers(spark, cfg, run_ts, as_of, resume, before)


def run_ledger(spark: SparkSession, cfg: PipelineConfig) -> RunLedger:
    return RunLedger(spark, f"{cfg.database('landing')}.run_ledger")


def _run_layers(spark: SparkSession, cfg: PipelineConfig, run_ts: datetime,
                as_of: date, resume: bool = True,
                before: Callable[[str], None] | None = None) -> dict[str, dict[str, int]]:
    result = {}
    ledger = run_ledger(spark, cfg)
    run_id = f"{run_ts.isoformat()} as of {as_of.isoformat()}"
    inputs = fingerprint(spark, [f"{cfg.volume_path}/{cfg.data_files[f]}" for _, f in _FEEDS])
    for layer, fn in [("bronze", lambda: run_bronze(spark, cfg, run_ts)),
                      ("silver", lambda: run_silver(spark, cfg, run_ts, as_of)),
                      ("gold", lambda: run_gold(spark, cfg, run_ts))]:
        done = ledger.finished(run_id, layer, inputs) if resume else None
        if done is not None:
            result[layer] = done
            inputs = ledger.entry(run_id, layer, inputs)
            continue
        ledger.start(run_id, layer, inputs)
        try:
            if before:
                before(layer)
            result[layer] = fn()
            ledger.finish(run_id, layer, inputs, result[layer])
            inputs = ledger.entry(run_id, layer, inputs)
        except Exception as e:
            _audit(spark, cfg, [AuditRow(f"{layer} layer", "-", None, run_ts, layer,
                                         tables.FAILED, f"{type(e).__name__}: {e}")])
            raise
    return result
