"""Rules as a table against the rules as one expression."""
import random

from pyspark.sql import functions as F

from strata.functions.cleanse import REFERENCE_CATEGORY_RULES, categorise
from strata.operators import rule_table as rt

NAMES = ["Trachea Infection", "Skin Infection", "Heart Ache", "Gouty Arthritis", "", None, "High Blood Pressure", "x", "Cold", "COLD hot", "ÄCHE"]


def test_equal_to_the_reference_rules(spark):
    names = NAMES + [k.title() + " of " + str(i) for i, (_, ks) in enumerate(REFERENCE_CATEGORY_RULES) for k in ks]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names * 2)], "name string, id int")
    one = {r.id: r.c for r in df.select("id", categorise("name", REFERENCE_CATEGORY_RULES).alias("c")).collect()}
    got = rt.categorise_by_table(df, "name", rt.rules_frame(spark, REFERENCE_CATEGORY_RULES))
    assert {r.id: r.category for r in got.collect()} == one


def test_five_thousand_rules(spark):
    rnd = random.Random(3)
    word = lambda a, b: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(a, b)))
    rules = [(f"c{rnd.randint(0, 400)}", [word(1, 9) for _ in range(rnd.randint(1, 2))]) for _ in range(5000)]
    rules = [(c, [k for k in ks if len(k) > 3 or rnd.random() < 0.02]) for c, ks in rules]
    names = [word(0, 30) for _ in range(300)]
    want = {n: next((c for c, ks in rules if any(k in n for k in ks)), "Other") for n in names}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.category for r in rt.categories(df, "name", rt.rules_frame(spark, rules)).collect()}
    assert got == want
    # a keyword meets names by one n-gram
    assert rt.anchored(rt.rules_frame(spark, rules)).groupBy("rule_order", "category", "keyword").count().filter("count > 1").isEmpty()


def test_empty_rules_and_names(spark):
    none = spark.createDataFrame([], "rule_order int, category string, keyword string")
    df = spark.createDataFrame([("a",), (None,)], "name string")
    assert [r.category for r in rt.categorise_by_table(df, "name", none).collect()] == ["Other", "Other"]
    blank = spark.createDataFrame([(0, "x", ""), (1, "y", None)], none.schema)
    assert {r.category for r in rt.categories(df, "name", blank).collect()} == {"Other"}
    assert rt.categories(df.filter(F.lit(False)), "name", blank).count() == 0
