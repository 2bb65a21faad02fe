"""Mart options for the hazards the original leaves open (H7, H14, H15, H19) and H8's check."""

from datetime import date

from pyspark.sql import functions as F

from strata.operators import scd2
from strata.plans import marts, star

STAR = ("condition_name string, condition_category string, drug_name string, drug_type string, "
        "drug_form string, drug_avg_price double, effectiveness_score double, "
        "ease_of_use_score double, satisfaction_score double, review_count int, price double")


def _star(spark):
    rows = [
        ("Pain", "P", "a", "RX", "Tablet", 10.0, 9.0, 1.0, 1.0, 5, None),
        ("Pain", "P", "a", "RX", "Tablet", 10.0, 1.0, 1.0, 1.0, None, 20.0),
        ("Pain", "P", "b", "OTC", "Gel", 30.0, 6.0, 2.0, None, 1, 40.0),
        ("Pain", "P", "b", "OTC", "Gel", 30.0, 6.0, 2.0, 3.0, 1, None),
        ("Skin", "D", "c", "RX/OTC", "Cream", None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, STAR)


def test_summary_default_distinct_and_best_by_mean(spark):
    s = _star(spark)
    row = {r["condition_name"]: r for r in marts.summary(s).collect()}
    p = row["Pain"]
    assert (p["total_drugs_available"], p["rx_drugs_count"], p["otc_drugs_count"]) == (4, 2, 2)
    assert (p["tablet_options"], p["topical_options"]) == (2, 2)
    assert p["best_drug_by_effectiveness"] == "a"          # best single row: 9.0
    assert row["Skin"]["best_drug_by_effectiveness"] == "c"  # all-null group still names one
    assert (p["min_price"], p["max_price"], p["total_patient_reviews"]) == (10.0, 40.0, 7)
    mean = {r["condition_name"]: r for r in
            marts.summary(s, marts.MartSpec(best_by="mean", distinct_counts=True)).collect()}
    assert mean["Pain"]["best_drug_by_effectiveness"] == "b"   # mean 6.0 beats 5.0
    assert mean["Pain"]["distinct_drugs_available"] == 2


def test_ranking_missing_scores_and_reweight(spark):
    s = _star(spark)
    r = {x["drug_name"]: x for x in marts.ranking(s).collect()}
    assert r["a"]["overall_score"] == round(0.4 * 5 + 0.4 * 1 + 0.2 * 1, 2)
    assert r["c"]["overall_score"] == 0.0 and r["c"]["overall_rank"] == 1
    rw = {x["drug_name"]: x for x in
          marts.ranking(s, marts.MartSpec(reweight_missing=True)).collect()}
    assert rw["c"]["overall_score"] is None


def test_value_mart_tiers_and_percentiles(spark):
    v = {x["drug_name"]: x for x in marts.value(_star(spark)).collect()}
    assert set(v) == {"a", "b"}                             # item with no price at all dropped
    assert v["a"]["price_tier"] == "Low (<$50)" and v["a"]["average_price"] == 15.0
    assert (v["a"]["price_percentile"], v["b"]["price_percentile"]) == (50, 100)
    assert v["a"]["conditions_treated"] == 2                # counts rows, as the original


def test_version_key_and_duplicate_keys(spark):
    spec = scd2.Scd2Spec(keys=("k",), tracked=("v",))
    h = scd2.initial(spark.createDataFrame([("x", 1)], "k string, v int"), spec, date(2024, 1, 1))
    h2 = scd2.merge(h, spark.createDataFrame([("x", 2)], "k string, v int"), spec,
                    date(2024, 2, 1))
    keys = {r[0] for r in h2.select(scd2.version_key(spec)).collect()}
    assert len(keys) == 2
    df = spark.createDataFrame([("p",), ("p",), ("q",)], "performance_key string")
    d = star.duplicate_keys(df, "performance_key").first()
    assert (d["repeated_keys"], d["rows_with_repeated_keys"]) == (1, 2)
    assert F is not None
