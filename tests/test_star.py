"""Silver builders on literal feeds (R3, R5, R6, J4, J5, H1, H10, F10, F11)."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.functions.keys import with_lineage
from strata.plans import star

RUN = datetime(2024, 1, 1)
RAW = ("condition string, drug string, indication string, type string, reviews string, "
       "effective string, ease_of_use string, satisfaction string, information string")
CLEAN = ("condition string, drug string, ease_of_use double, effective double, form string, "
         "indication string, price double, reviews double, satisfaction double, type string")


def feeds(spark):
    raw = spark.createDataFrame([
        ("heart ache", " asp ", "x", None, "12 Reviews", "4.5", "4", "3", "info b"),
        ("Heart Ache", "asp", "x", "RX", "none", "n/a", "4", "3", "info a"),
        ("skin", "gel1", "x", " OTC ", "3", "2", "2", "2", "g"),
    ], RAW)
    clean = spark.createDataFrame([
        ("heart ache", "asp", 4.0, 4.0, "Tablet", "x", 10.0, 5.0, 3.0, None),
        ("heart ache", "asp", 4.0, 4.0, "Capsule", "x", 30.0, 9.7, 3.0, "RX"),
        ("heart ache", "asp", 4.0, 4.0, "Liquid", "x", 20.0, 9.2, 3.0, "RX"),
        ("skin", "gel1", 2.0, 2.0, "Gel", "x", 5.0, 1.0, 2.0, "OTC"),
    ], CLEAN)
    raw = with_lineage(raw, RUN, source_file="raw")
    clean = with_lineage(clean, RUN, source_file="clean")
    return star.cleanse_raw(raw), star.cleanse_clean(clean)


def test_item_dimension_survivor_and_unknown_type(spark):
    raw_c, clean_c = feeds(spark)
    dim = {r["drug_name"]: r for r in star.item_dimension(raw_c, clean_c).collect()}
    assert set(dim) == {"asp", "gel1"}
    # asp: (Unknown, Tablet) 5 reviews vs (RX, Capsule) 9 vs (RX, Liquid) 9 -> most reviews,
    # then type, then form: RX / Capsule
    a = dim["asp"]
    assert (a["drug_type"], a["drug_form"], a["average_price"]) == ("RX", "Capsule", 30.0)
    assert a["drug_information"] == "info a"          # min(), repeatable
    assert dim["gel1"]["drug_type"] == "OTC"          # ' OTC ' trimmed, meets the clean feed


def test_group_dimension_and_fact(spark):
    raw_c, clean_c = feeds(spark)
    g = {r["condition_name"]: r for r in star.group_dimension(raw_c, clean_c, RUN).collect()}
    assert g["Heart Ache"]["total_drugs_available"] == 5          # rows, not distinct items
    assert g["Heart Ache"]["total_reviews_count"] == 12 + 0 + 5 + 9 + 9
    assert g["Heart Ache"]["condition_category"] == "Pain Management"
    assert g["Skin"]["condition_category"] == "Dermatology"
    f = star.fact(raw_c, clean_c)
    rows = f.collect()
    assert len(rows) == 7 and {r["data_source"] for r in rows} == {"raw", "clean"}
    raw_rows = [r for r in rows if r["data_source"] == "raw"]
    assert all(r["price"] is None and r["drug_form"] is None for r in raw_rows)
    assert f.filter(F.col("performance_key").isNull()).count() == 0


def test_star_view_inner_joins(spark):
    raw_c, clean_c = feeds(spark)
    items = star.item_dimension(raw_c, clean_c).filter(F.col("drug_name") == "asp")
    groups = star.group_dimension(raw_c, clean_c, RUN)
    v = star.star_view(star.fact(raw_c, clean_c), items, groups).collect()
    assert len(v) == 5 and {r["drug_name"] for r in v} == {"asp"}    # gel1 facts drop out
    assert {r["drug_form"] for r in v} == {"Capsule"}                 # the item's form is used
