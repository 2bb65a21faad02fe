"""End-to-end pipeline (R7, R17): two daily runs over small CSV feeds."""

import os
from datetime import date, datetime

import pytest

from strata.config import PipelineConfig, default_config_dict
from strata.plans import pipeline

RAW = ("condition,drug,indication,type,reviews,effective,ease_of_use,satisfaction,information\n"
       "Heart Ache,aspirin,x,RX,12 Reviews,4.5,4,3,info a\n"
       "skin rash,cream1,x, OTC ,none,n/a,3,3,info b\n"
       ",nameless,x,RX,1,1,1,1,info c\n")
CLEAN_1 = ("condition,drug,ease_of_use,effective,form,indication,price,reviews,satisfaction,type\n"
           "Heart Ache,aspirin,4,4.5,Tablet,x,40,10,3,RX\n"
           "skin rash,cream1,3,3,Cream,x,120,5,3,OTC\n")
CLEAN_2 = CLEAN_1.replace("Tablet,x,40", "Tablet,x,60")


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.csv", "w") as f:
        f.write(text)


def test_two_runs(spark, scratch):
    vol = f"{scratch}/volume"
    cfg = PipelineConfig.from_dict(default_config_dict(vol), prefix="t_pipe_")
    _write(f"{vol}/Drug.csv", RAW)
    _write(f"{vol}/Drug_clean.csv", CLEAN_1)
    r1 = pipeline.run_pipeline(spark, cfg, datetime(2024, 1, 1), date(2024, 1, 1),
                               location_root=f"{scratch}/wh")
    assert r1["bronze"] == {"drug_reviews_raw": 3, "drug_reviews_clean": 2}
    assert r1["silver"]["dim_drugs"] == 2
    _write(f"{vol}/Drug_clean.csv", CLEAN_2)
    pipeline.run_pipeline(spark, cfg, datetime(2024, 1, 2), date(2024, 1, 2),
                          location_root=f"{scratch}/wh")
    dim = spark.table(cfg.table("silver", "dim_drugs"))
    asp = sorted((r["average_price"], r["is_current"]) for r in dim.collect()
                 if r["drug_name"] == "aspirin")
    assert asp == [(40.0, False), (60.0, True)]                # price change -> new version
    assert spark.table(cfg.table("silver", "dim_drugs_history")).count() == 1
    q = spark.table(f"{cfg.database('silver')}.drug_reviews_raw_quarantine").collect()
    assert len(q) == 1 and q[0]["failed_rules"] == ["group_present"]
    cond = {r["condition_name"]: r for r in
            spark.table(cfg.table("silver", "dim_conditions")).collect()}
    assert cond["Heart Ache"]["condition_category"] == "Pain Management"
    assert cond["Heart Ache"]["first_seen_date"] == datetime(2024, 1, 1)   # carried over
    assert cond["Heart Ache"]["last_updated_date"] == datetime(2024, 1, 2)
    rank = spark.table(cfg.table("gold", "drug_effectiveness_ranking")).collect()
    assert {r["drug_name"] for r in rank} == {"aspirin", "cream1"}
    audit = spark.table(cfg.table("landing", "metadata_tracking")).collect()
    assert len(audit) == 2 * 12 and all(r["status"] in ("success", "warning") for r in audit)


def test_bucketed_star_join_needs_no_fact_shuffle(spark, scratch):
    from strata.operators import scd2
    from strata.plans import star
    vol = f"{scratch}/volume"
    d = default_config_dict(vol)
    d["pipeline"]["bucket_count"] = 4
    cfg = PipelineConfig.from_dict(d, prefix="t_bkt_")
    _write(f"{vol}/Drug.csv", RAW)
    _write(f"{vol}/Drug_clean.csv", CLEAN_1)
    pipeline.ensure_databases(spark, cfg, f"{scratch}/wh")
    pipeline.run_bronze(spark, cfg, datetime(2024, 1, 1))
    pipeline.run_silver(spark, cfg, datetime(2024, 1, 1), date(2024, 1, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = scd2.current_view(spark.table(cfg.table("silver", "dim_drugs")),
                                  cfg.scd2_spec("dim_drugs"))
        fact = spark.table(cfg.table("silver", "fact_drug_performance"))
        j = fact.join(items, "drug_key")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == fact.count()
        assert star is not None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pipeline_drops_its_stages(spark, scratch):
    from strata.session import _scratch_db
    vol = f"{scratch}/volume"
    cfg = PipelineConfig.from_dict(default_config_dict(vol), prefix="t_stage_")
    _write(f"{vol}/Drug.csv", RAW)
    _write(f"{vol}/Drug_clean.csv", CLEAN_1)
    db = _scratch_db(spark)
    before = {t.name for t in spark.catalog.listTables(db)}
    pipeline.run_pipeline(spark, cfg, datetime(2024, 1, 1), date(2024, 1, 1),
                          location_root=f"{scratch}/wh")
    after = {t.name for t in spark.catalog.listTables(db)}
    assert after <= before
    assert spark.table(cfg.table("gold", "drug_effectiveness_ranking")).count() > 0


def test_a_stopped_run_goes_on_after_the_last_finished_stage(spark, scratch, monkeypatch):
    vol = f"{scratch}/volume"
    cfg = PipelineConfig.from_dict(default_config_dict(vol), prefix="t_resume_")
    _write(f"{vol}/Drug.csv", RAW)
    _write(f"{vol}/Drug_clean.csv", CLEAN_1)
    args = (spark, cfg, datetime(2024, 1, 1), date(2024, 1, 1))
    ran = []
    for layer in ("bronze", "silver", "gold"):
        own = getattr(pipeline, f"run_{layer}")
        monkeypatch.setattr(pipeline, f"run_{layer}", lambda *a, own=own, layer=layer: (ran.append(layer), own(*a))[1])

    def stop(layer):
        if layer == "gold":
            raise RuntimeError("stopped")
    for _ in range(2):                              # the same failure twice is one audit row
        with pytest.raises(RuntimeError):
            pipeline.run_pipeline(*args, location_root=f"{scratch}/wh", before=stop)
    assert ran == ["bronze", "silver"]
    result = pipeline.run_pipeline(*args, location_root=f"{scratch}/wh")
    assert ran == ["bronze", "silver", "gold"] and result["bronze"]["drug_reviews_raw"] == 3
    assert pipeline.run_pipeline(*args, location_root=f"{scratch}/wh") == result and len(ran) == 3
    audit = spark.table(cfg.table("landing", "metadata_tracking")).collect()
    assert sorted(r["status"] for r in audit if r["layer"] == "gold") == ["failed"] + ["success"] * 3
    assert len(audit) == 13
    pipeline.run_pipeline(*args, location_root=f"{scratch}/wh", resume=False)
    assert spark.table(cfg.table("landing", "metadata_tracking")).filter("status <> 'failed' AND layer = 'bronze'").count() == 2
    _write(f"{vol}/Drug_clean.csv", CLEAN_2)        # other files are another input
    pipeline.run_pipeline(*args, location_root=f"{scratch}/wh")
    assert ran[-3:] == ["bronze", "silver", "gold"]


def test_records_that_cannot_be_read_are_kept_apart_and_counted(spark, scratch):
    vol = f"{scratch}/volume"
    d = default_config_dict(vol)
    d["pipeline"]["multi_line"] = {"raw_reviews": False}
    cfg = PipelineConfig.from_dict(d, prefix="t_unreadable_")
    _write(f"{vol}/Drug.csv", RAW + "Gout,\"open,x,RX,1,1,1,1,info\nGout,b,x,RX\nGout,c,x,RX,1,1,1,1,info,more\nGout,d,x,RX,1,1,1,1,i\n")
    _write(f"{vol}/Drug_clean.csv", CLEAN_1)
    pipeline.ensure_databases(spark, cfg, f"{scratch}/wh")
    n = pipeline.run_bronze(spark, cfg, datetime(2024, 1, 1))
    assert n == {"drug_reviews_raw": 4, "drug_reviews_clean": 2}
    bad = spark.table(f"{cfg.database('bronze')}.drug_reviews_raw_unreadable").collect()
    assert sorted(r["record"] for r in bad) == ['Gout,"open,x,RX,1,1,1,1,info', "Gout,b,x,RX", "Gout,c,x,RX,1,1,1,1,info,more"]
    assert all(r["source_file"].endswith("Drug.csv/part.csv") for r in bad)
    row = spark.table(cfg.table("landing", "metadata_tracking")).filter("table_name = 'drug_reviews_raw_unreadable'").first()
    assert (row["record_count"], row["status"]) == (3, "warning")
    # with the quarantine off they are loaded as far as they go, and still kept and counted
    d["pipeline"]["enable_quarantine"] = False
    loose = PipelineConfig.from_dict(d, prefix="t_unreadable_")
    assert pipeline.run_bronze(spark, loose, datetime(2024, 1, 2))["drug_reviews_raw"] == 7


def test_the_unreadable_column_alone_can_be_asked_for(spark, scratch):
    from strata.sources import csv
    _write(f"{scratch}/feed", "a,b\n1,2\n1\n")
    df = csv.read_text_csv(spark, f"{scratch}/feed", unreadable_col="bad")
    assert [r.bad for r in df.select("bad").filter("bad IS NOT NULL").collect()] == ["1"]
    assert df.count() == 2


@pytest.mark.parametrize("quarantine", [True, False])
def test_each_feed_is_cleansed_and_judged_in_one_write(spark, scratch, monkeypatch, quarantine):
    from strata.operators import quality
    from strata.sources import tables
    vol = f"{scratch}/volume"
    d = default_config_dict(vol)
    d["pipeline"]["enable_quarantine"] = quarantine
    cfg = PipelineConfig.from_dict(d, prefix=f"t_once_{quarantine}_".lower())
    _write(f"{vol}/Drug.csv", RAW)
    _write(f"{vol}/Drug_clean.csv", CLEAN_1)
    put, read = tables.replace_table, {}

    def seen(df, name, *a, **kw):
        read[name.rsplit(".", 1)[1]] = " ".join(df.inputFiles())
        return put(df, name, *a, **kw)
    monkeypatch.setattr(tables, "replace_table", seen)
    monkeypatch.setattr(quality, "counts", lambda *a: pytest.fail("a pass of its own over the feed"))
    pipeline.run_pipeline(spark, cfg, datetime(2024, 1, 1), date(2024, 1, 1), location_root=f"{scratch}/wh")
    audit = {r["table_name"]: r for r in spark.table(cfg.table("landing", "metadata_tracking")).collect()}
    if not quarantine:
        rows = spark.table(cfg.table("landing", "metadata_tracking")).filter("layer = 'silver' AND table_name = 'drug_reviews_raw'").collect()
        assert [(r.record_count, r.status, r.notes) for r in rows] == [(3, "warning", "rows failing rules, kept: {'failed_group_present': 1}")]
        return
    assert "raw_cleansed" in read["drug_reviews_raw_quarantine"] and "bronze" not in read["drug_reviews_raw_quarantine"]
    assert audit["drug_reviews_raw_quarantine"]["notes"] == (
        "rows failing rules: {'rows': 3, 'failed_item_present': 0, 'failed_group_present': 1, 'quarantined_rows': 1, 'valid_rows': 2}")
    bad = spark.table(f"{cfg.database('silver')}.drug_reviews_raw_quarantine")
    assert [r.drug_clean for r in bad.collect()] == ["nameless"] and bad.columns[-1] == "failed_rules"
    assert spark.table(cfg.table("silver", "fact_drug_performance")).count() == 4
