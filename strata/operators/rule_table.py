"""Keyword rules as a table: the first rule, by order, one of whose keywords a name contains.

``functions.cleanse.categorise`` writes its rules into one expression, which is right for a
handful. A list of thousands would make every row try every keyword. Here rules are rows
(order, category, keyword) and meet only the names that can contain them:

* work is done on distinct names, found by a keys-only aggregate;
* a keyword is anchored at one of its character n-grams (``GRAM`` characters, or the whole of a shorter
  keyword), the one that the fewest keywords have; a name that contains the keyword has that n-gram;
* names and keywords meet on n-grams, the keyword is looked for, and the least order wins by a
  ``min`` that combines before its shuffle.

A rule costs the names that hold its rarest n-gram. As in ``categorise``, names are compared in lower
case, a keyword matches anywhere in the name ("old" in "Cold"), names that match nothing get ``otherwise``, and a null name counts
as one that matches nothing. Empty and null keywords match nothing; of rules of one order the category first in the alphabet wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Ordered (category, keywords) rules as a table."""
    rows = [(n, category, k) for n, (category, keywords) in enumerate(rules) for k in keywords]
    return spark.createDataFrame(rows, "rule_order int, category string, keyword string")


def _grams(text: Column, size: Column | int) -> Column:
    """All distinct substrings of ``size`` characters of a text of at least that length."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def anchored(rules: DataFrame, gram: int = GRAM) -> DataFrame:
    """``rules`` with the n-gram each keyword is looked up by."""
    keyed = (rules.select("rule_order", "category", F.lower("keyword").alias("keyword"))
             .filter(F.length("keyword") > 0).distinct())
    size = F.least(F.length("keyword"), F.lit(gram))
    spread = keyed.withColumn("gram", F.explode(_grams(F.col("keyword"), size)))
    often = spread.groupBy("gram").agg(F.count_distinct("keyword").alias("n"))
    return (spread.join(often, "gram").groupBy("rule_order", "category", "keyword")
            .agg(F.min(F.struct("n", "gram"))["gram"].alias("gram")))


def categories(names: DataFrame, name: str, rules: DataFrame, otherwise: str = "Other", gram: int = GRAM) -> DataFrame:
    """One row per distinct ``name`` with its ``category``."""
    distinct = names.select(F.col(name).alias("name")).distinct()
    low = F.lower("name")
    looked = distinct.filter("name IS NOT NULL").withColumn("gram", F.explode(F.array_distinct(F.flatten(F.array(*(
        F.when(F.length(low) >= n, _grams(low, n)).otherwise(F.array().cast("array<string>")) for n in range(1, gram + 1)))))))
    hits = (looked.join(anchored(rules, gram), "gram").filter(F.contains(low, F.col("keyword")))
            .groupBy(F.col("name").alias("hit")).agg(F.min(F.struct("rule_order", "category"))["category"].alias("category")))
    return (distinct.join(hits, F.col("name") == F.col("hit"), "left")
            .select(F.col("name").alias(name), F.coalesce("category", F.lit(otherwise)).alias("category")))


def categorise_by_table(df: DataFrame, name: str, rules: DataFrame, column: str = "category", otherwise: str = "Other") -> DataFrame:
    """``df`` with the category of each row's name."""
    if column in df.columns:
        raise ValueError(f"there is a column {column!r} already")
    found = categories(df, name, rules, otherwise).select(F.col(name).alias("__rule_name"), F.col("category").alias(column))
    return df.join(found, F.col(name).eqNullSafe(F.col("__rule_name")), "left").drop("__rule_name")
