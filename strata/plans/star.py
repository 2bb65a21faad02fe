"""Silver layer: cleanse two feeds, conform them into two dimensions and a fact, join the star.

Feed contracts are the original's (see ``sources.contracts``): a text-only
"raw" feed and a typed "clean" feed. Every step is a pure DataFrame function.

Fixed relative to the original (see SURVEY hazards):
* the item dimension's survivor per key is chosen by a total order (highest
  review sum, then type, form) instead of an arbitrary ``dropDuplicates``;
* a missing type is normalised to "Unknown" in BOTH feeds before they are
  joined, so the two feeds meet on the same label;
* ``first(information)`` becomes ``min(information)`` (repeatable);
* the first-seen date of a group is carried from the previous dimension.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleanse import (REFERENCE_CATEGORY_RULES, UNKNOWN, categorise, label,
                                 leading_int, strict_int, title_case, tolerant, trim_spaces)
from ..functions.keys import composite_key, hash_key
from ..functions.scoring import exact_avg
from ..functions.timestamps import ts_lit

# Fixed value of the original: indication label of every group.
STANDARD_INDICATION = "Standard"


def cleanse_raw(raw: DataFrame) -> DataFrame:
    """Raw (all-text) feed -> typed, standardised columns."""
    return raw.select(
        "*",
        leading_int("reviews").alias("review_count"),
        label("type").alias("drug_type_clean"),
        title_case("condition").alias("condition_clean"),
        trim_spaces("drug").alias("drug_clean"),
        tolerant("effective", "double").alias("effective_clean"),
        tolerant("ease_of_use", "double").alias("ease_of_use_clean"),
        tolerant("satisfaction", "double").alias("satisfaction_clean"),
    )


def cleanse_clean(clean: DataFrame) -> DataFrame:
    """Typed feed -> standardised labels; review count truncated to int."""
    return clean.select(
        "*",
        label("type").alias("drug_type_clean"),
        title_case("condition").alias("condition_clean"),
        trim_spaces("drug").alias("drug_clean"),
        strict_int("reviews").alias("review_count"),
    )


def item_dimension(raw_c: DataFrame, clean_c: DataFrame) -> DataFrame:
    """One row per item key: type, form, mean price and description from both feeds.

    Two aggregates (one exchange each), one full outer join on (item, type),
    then one survivor per key by a total order (a row_number = 1 that Spark
    limits per key before its shuffle).
    """
    # min over text has no fixed-width buffer (Spark sorts to aggregate it), so
    # distinct texts are found first by a keys-only hash aggregate
    from_raw = (raw_c.select("drug_clean", "drug_type_clean", "information").distinct()
                .groupBy("drug_clean", "drug_type_clean")
                .agg(F.min("information").alias("drug_information")))
    from_clean = (clean_c.groupBy("drug_clean", "drug_type_clean", "form")
                  .agg(exact_avg("price").alias("average_price"),
                       F.sum("review_count").alias("total_reviews")))
    both = from_raw.join(from_clean, ["drug_clean", "drug_type_clean"], "full_outer")
    keyed = both.select(
        hash_key("drug_clean").alias("drug_key"),
        F.col("drug_clean").alias("drug_name"),
        F.coalesce("drug_type_clean", F.lit(UNKNOWN)).alias("drug_type"),
        F.coalesce("form", F.lit(UNKNOWN)).alias("drug_form"),
        "average_price", "drug_information", "total_reviews")
    order = [F.col("total_reviews").desc_nulls_last(), F.col("drug_type").asc_nulls_first(),
             F.col("drug_form").asc_nulls_first()]
    w = Window.partitionBy("drug_key").orderBy(*order)
    return (keyed.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
            .select("drug_key", "drug_name", "drug_type", "drug_form", "average_price",
                    "drug_information"))


def group_dimension(raw_c: DataFrame, clean_c: DataFrame, run_ts: datetime,
                    rules: Sequence | None = None, previous: DataFrame | None = None,
                    distinct_counts: bool = False) -> DataFrame:
    """One row per group (condition): item mentions, review total, keyword category.

    ``total_drugs_available`` counts fact rows, as the original does; with
    ``distinct_counts`` a ``distinct_drugs_available`` column counts items.
    ``first_seen_date`` is the run time of the first load that saw the group
    (carried from ``previous``), ``last_updated_date`` the current run time.
    """
    rules = REFERENCE_CATEGORY_RULES if rules is None else rules
    cols = ["condition_clean", "drug_clean"]
    rows = (raw_c.select(*cols, F.coalesce("review_count", F.lit(0)).alias("review_count"))
            .unionByName(clean_c.select(*cols, F.coalesce("review_count", F.lit(0))
                                        .alias("review_count"))))
    g = (rows.groupBy("condition_clean")
         .agg(F.count("drug_clean").alias("total_drugs_available"),
              F.sum("review_count").alias("total_reviews_count"),
              *([F.count_distinct("drug_clean").alias("distinct_drugs_available")]
                if distinct_counts else [])))
    dim = g.select(
        hash_key("condition_clean").alias("condition_key"),
        F.col("condition_clean").alias("condition_name"),
        categorise("condition_clean", rules).alias("condition_category"),
        F.lit(STANDARD_INDICATION).alias("indication_type"),
        "total_drugs_available", "total_reviews_count",
        *(["distinct_drugs_available"] if distinct_counts else []))
    return carry_first_seen(dim, previous, ["condition_key"], run_ts)


def carry_first_seen(dim: DataFrame, previous: DataFrame | None, keys: Sequence[str],
                     run_ts: datetime, first_col: str = "first_seen_date",
                     updated_col: str = "last_updated_date") -> DataFrame:
    """``first_seen = least(previous first_seen, now)``; new keys get ``now``.

    One left join on the keys against the previous dimension's key and date only.
    """
    now = ts_lit(run_ts)
    if previous is None:
        return dim.withColumn(first_col, now).withColumn(updated_col, now)
    prev = previous.select(*keys, F.col(first_col).cast("timestamp_ntz").alias("__prev_first"))
    return (dim.join(prev, list(keys), "left")
            .withColumn(first_col, F.least(F.col("__prev_first"), now))
            .withColumn(updated_col, now)
            .drop("__prev_first"))


def _fact_part(df: DataFrame, source: str, effective: str, ease: str, satisfaction: str,
               form: Column, price: Column) -> DataFrame:
    drug_key = hash_key("drug_clean")
    cond_key = hash_key("condition_clean")
    return df.select(
        drug_key.alias("drug_key"),
        cond_key.alias("condition_key"),
        F.col(effective).cast("double").alias("effectiveness_score"),
        F.col(ease).cast("double").alias("ease_of_use_score"),
        F.col(satisfaction).cast("double").alias("satisfaction_score"),
        F.col("review_count").cast("int").alias("review_count"),
        form.alias("drug_form"),
        F.col("drug_type_clean").alias("drug_type"),
        price.alias("price"),
        F.lit(source).alias("data_source"),
        F.col("ingestion_timestamp").alias("load_timestamp"),
        composite_key(drug_key, cond_key, F.lit(source)).alias("performance_key"))


def fact(raw_c: DataFrame, clean_c: DataFrame) -> DataFrame:
    """Both feeds projected to one fact schema (typed nulls where a feed lacks a
    measure), tagged with their source, keyed, and unioned by name. No shuffle."""
    r = _fact_part(raw_c, "raw", "effective_clean", "ease_of_use_clean", "satisfaction_clean",
                   F.lit(None).cast("string"), F.lit(None).cast("double"))
    c = _fact_part(clean_c, "clean", "effective", "ease_of_use", "satisfaction",
                   F.col("form").cast("string"), F.col("price").cast("double"))
    return r.unionByName(c)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many key values repeat and how many rows they cover.

    For keys documented unique that are not by construction (the performance
    key repeats when an item has several forms); reads the key column only."""
    return (df.groupBy(key).count().filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("repeated_keys"),
                 F.coalesce(F.sum("count"), F.lit(0)).alias("rows_with_repeated_keys")))


def star_view(fact_df: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """Fact joined to the current item and group rows, in the marts' star contract.

    Inner joins: facts whose key finds no dimension row drop out, as in the
    original. The dimensions are one row per key; AQE broadcasts them when
    their measured size is under the broadcast threshold, else sort-merge.
    The item's type and form (not the fact's) are used, as in the original.
    """
    f, d, g = fact_df.alias("f"), items.alias("d"), groups.alias("g")
    return (f.join(d, F.col("f.drug_key") == F.col("d.drug_key"))
            .join(g, F.col("f.condition_key") == F.col("g.condition_key"))
            .select(F.col("g.condition_name"), F.col("g.condition_category"),
                    F.col("d.drug_name"), F.col("d.drug_type"), F.col("d.drug_form"),
                    F.col("d.average_price").alias("drug_avg_price"),
                    F.col("f.effectiveness_score"), F.col("f.ease_of_use_score"),
                    F.col("f.satisfaction_score"), F.col("f.review_count"), F.col("f.price")))
