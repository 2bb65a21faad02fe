"""Referential check: exact at any filter size, both sides partition the fact."""
import pytest
from pyspark.sql import functions as F

from strata.operators import references as refs
from strata.operators.references import Reference


@pytest.fixture
def star(spark):
    fact = spark.range(4000).select(
        F.col("id"), F.when(F.col("id") % 17 == 0, None).otherwise(F.concat(F.lit("i"), F.col("id") % 300)).alias("item"),
        (F.col("id") % 41).cast("string").alias("grp"))
    items = spark.range(280).select(F.concat(F.lit("i"), "id").alias("item_key"))
    groups = spark.range(40).select(F.col("id").cast("string").alias("grp"), F.lit(1).alias("id"))
    return fact, [Reference("item", items, "item_key", "items"), Reference("grp", groups, "grp", "groups")]


def expected(i):
    out = []
    if i % 17 == 0:
        out.append("item is null")
    elif i % 300 >= 280:
        out.append("item not in items")
    if i % 41 == 40:
        out.append("grp not in groups")
    return out


@pytest.mark.parametrize("words", [1, 64, refs.MAX_WORDS])
def test_exact_at_any_filter_size(spark, star, words):
    fact, references = star
    got = {r["id"]: r[refs.REASONS] for r in refs.find_orphans(fact, references, max_words=words).collect()}
    assert got == {i: expected(i) for i in range(4000)}


def test_split_partitions_the_fact_and_counts_reasons(spark, star):
    fact, references = star
    valid, orphans = refs.split(fact, references)
    assert valid.columns == fact.columns
    bad = {i for i in range(4000) if expected(i)}
    assert {r["id"] for r in orphans.collect()} == bad and valid.count() == 4000 - len(bad)
    counts = refs.orphan_counts(orphans)
    assert counts == {k: sum(k in expected(i) for i in range(4000)) for k in
                      ("grp not in groups", "item is null", "item not in items")}


def test_the_filter_decides_nearly_all_orphans(spark, star):
    fact, (items, _) = star
    words, size = refs.bloom_words(items.dimension, "item_key", 280)
    assert words.count() <= size <= refs.MAX_WORDS
    strangers = spark.range(10000).select(F.concat(F.lit("x"), "id").alias("item"))
    through = (strangers.withColumn("word", refs._word(F.col("item"), size)).join(words, "word")
               .filter(F.col("bits").bitwiseAND(refs._mask(F.col("item"))) == refs._mask(F.col("item"))).count())
    assert through < 300


def test_empty_sides_and_clashing_names(spark, star):
    fact, references = star
    none = [Reference("item", references[0].dimension.limit(0), "item_key", "items")]
    assert refs.split(fact, none)[0].count() == 0
    assert refs.find_orphans(fact.limit(0), references).count() == 0
    with pytest.raises(ValueError, match="clash"):
        refs.find_orphans(fact.withColumn("orphan_of", F.lit(1)), references)
