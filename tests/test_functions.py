"""Column functions: cleansing, keys, scores (FIXTURES B: F4, F5, F3, F18, H5, F15-F17)."""

from pyspark.sql import functions as F

from strata.functions import (categorise, composite_key, guarded_ratio, hash_key, label,
                              leading_int, record_id, strict_int, tier, title_case, to_snake,
                              tolerant, weighted_score)


def col1(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_leading_int(spark):
    got = col1(spark, ["12 Reviews", "1,234 Reviews", "none", "", None, "99999999999 R"],
               leading_int)
    assert got == [12, 1, None, None, None, None]


def test_tolerant_cast(spark):
    assert col1(spark, ["4.5", "n/a", "", None], lambda c: tolerant(c, "double")) == \
        [4.5, None, None, None]


def test_strict_int_truncates(spark):
    assert col1(spark, [12.7, -3.9, None], strict_int, "double") == [12, -3, None]


def test_title_case(spark):
    got = col1(spark, ["  high BLOOD pressure ", "NON-SMALL cell", "acute (PAIN)", None],
               title_case)
    assert got == ["High Blood Pressure", "Non-small Cell", "Acute (pain)", None]


def test_label_defaults_and_crlf(spark):
    got = col1(spark, ["RX", "RX\r\n", "R\nX", " OTC ", "", None, "\tOTC"], label)
    # trim strips spaces only, as SQL TRIM does; tabs stay
    assert got == ["RX", "RX", "RX", "OTC", "Unknown", "Unknown", "\tOTC"]


def test_categorise_substring_and_order(spark):
    vals = ["Trachea infection", "Skin Infection", "Heart Ache", "Gouty Arthritis", "", None,
            "acid reflux", "Type 2 Diabetes"]
    got = col1(spark, vals, categorise)
    assert got == ["Pain Management", "Dermatology", "Pain Management", "Pain Management",
                   "Other", "Other", "Gastrointestinal", "Metabolic"]
    whole = col1(spark, vals[:1], lambda c: categorise(c, whole_word=True))
    assert whole == ["Infectious Disease"]


def test_to_snake():
    assert [to_snake(h) for h in ["Ease of Use", "easeOfUse", "ease-of-use", " Drug "]] == \
        ["ease_of_use", "ease_of_use", "ease_of_use", "drug"]


def test_hash_keys_and_record_ids(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), (None, None, None),
                                ("", "", "")], "p string, q string, r string")
    rows = df.select(hash_key("p").alias("h"), composite_key("p", "q", "r").alias("k"),
                     record_id(["p", "q", "r"], "reference").alias("ref"),
                     record_id(["p", "q", "r"], "unambiguous").alias("una")).collect()
    assert rows[2]["h"] is None
    assert rows[0]["ref"] == rows[1]["ref"]          # nulls skipped: collision (faithful)
    assert rows[0]["una"] != rows[1]["una"]          # unambiguous style keeps them apart
    assert rows[2]["una"] != rows[3]["una"]          # null is not the empty string
    assert rows[0]["k"] == rows[0]["ref"]


def test_weighted_score_half_up_and_missing(spark):
    df = spark.createDataFrame([(10.0, 10.0, 10.0), (None, 10.0, None), (8.905, 8.905, 8.905)],
                               "effectiveness_score double, satisfaction_score double, "
                               "ease_of_use_score double")
    got = [r[0] for r in df.select(weighted_score()).collect()]
    assert got == [10.0, 4.0, 8.91]
    rw = [r[0] for r in df.select(weighted_score(reweight_missing=True)).collect()]
    assert rw == [10.0, 10.0, 8.91]


def test_tier_edges(spark):
    got = col1(spark, [49.99, 50.0, 149.99, 150.0, 0.0, -5.0, None], tier, "double")
    assert got == ["Low (<$50)", "Medium ($50-$150)", "Medium ($50-$150)", "High (>$150)",
                   "Low (<$50)", "Low (<$50)", "High (>$150)"]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(5.0, 50.0), (5.0, 0.0), (None, 10.0), (5.0, None)],
                               "n double, d double")
    assert [r[0] for r in df.select(guarded_ratio("n", "d")).collect()] == \
        [10.0, 0.0, 0.0, 0.0]


def test_averages_lose_no_digit(spark):
    """Full doubles, in any order of rows and partitions; NaN and infinities as in a plain average."""
    import math
    import random
    from fractions import Fraction

    from strata.functions.scoring import add_parts, exact_avg, parts_avg, summed_parts
    rng = random.Random(5)
    groups = {
        "digits": [3.8523, 3.8567, 0.004], "mixed": [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 12) for _ in range(500)],
        "third": [1 / 3] * 7, "cancel": [1e15 + 0.5, -1e15, 0.25], "small": [1.2345678901234567e-5] * 3,
        "nan": [1.0, float("nan")], "inf": [float("inf"), 2.0], "both": [float("inf"), float("-inf")],
        "null": [None, None], "some": [None, 2.5], "huge": [1e300, 1.0],
        "tiny": [1e-25, 3e-25], "wide": [4e18] * 3, "far": [1e-30, 1e17, 0.5], "deep": [5e-324, 0.0],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    seen = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g string, x double").repartition(1 + 4 * seed)
        direct = {r.g: r.a for r in df.groupBy("g").agg(exact_avg("x").alias("a")).collect()}
        two = (df.withColumn("h", F.hash("x") % 3).groupBy("g", "h").agg(*summed_parts("x", "p"))
               .groupBy("g").agg(parts_avg(add_parts("p")).alias("a")))
        seen += [direct, {r.g: r.a for r in two.collect()}]
    assert all(repr(s) == repr({k: s[k] for k in s}) and {k: repr(v) for k, v in s.items()} ==
               {k: repr(v) for k, v in seen[0].items()} for s in seen)
    got = seen[0]
    for g in ("digits", "mixed", "third", "cancel", "small", "some", "tiny", "wide", "far"):
        xs = [Fraction(x) for x in groups[g] if x is not None]
        assert abs(Fraction(got[g]) - sum(xs) / len(xs)) <= 4 * Fraction(math.ulp(got[g])), g
    assert math.isnan(got["nan"]) and math.isinf(got["inf"]) and math.isnan(got["both"])
    assert got["null"] is None and got["huge"] == 5e299


def test_names_where_needs_no_lambda(spark):
    from strata.functions.cleanse import names_where
    from strata.operators import quality
    from strata.sources.contracts import conform
    from pyspark.sql.types import StructType
    df = spark.createDataFrame([(1, "x"), (None, "y"), (3, None)], "a int, b string")
    got = df.select(names_where({"big": F.col("a") > 2, "no_b": F.col("b").isNull()}).alias("n"), names_where({}).alias("none"))
    assert [(r.n, r.none) for r in got.collect()] == [([], []), ([], []), (["big", "no_b"], [])]   # null is not TRUE
    assert got.schema["n"].dataType.simpleString() == "array<string>"
    typed = conform(df, StructType.fromDDL("a string, b double"), errors_col="e")[0]
    assert sorted((r.a or "", r.e) for r in typed.collect()) == [("", ["b"]), ("1", ["b"]), ("3", [])]
    for plan in (typed, quality.flag(df, {"r": F.col("a") > 1})):
        assert "lambda" not in plan._jdf.queryExecution().executedPlan().toString()
