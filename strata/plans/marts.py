"""Gold marts over a star view, and the read queries users run on them.

The star view has one row per fact with these roles (names are the contract
``STAR_COLUMNS``): group (``condition_name``, ``condition_category``), item
(``drug_name``, ``drug_type``, ``drug_form``, ``drug_avg_price``), measures
(``effectiveness_score``, ``ease_of_use_score``, ``satisfaction_score``),
``review_count`` and ``price``.

Every mart derives from ``base``: ONE partial aggregate of the star at the
finest grain (group, item, type, form) whose parts all compose (exact decimal
sums, counts, min, max, an ordering struct for the best item). The star, which
is fact-sized, is therefore joined and shuffled once for all three marts; the
windows see one row per (group, item), never the raw facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import (PARTS, REFERENCE_PRICE_TIER_TOP, REFERENCE_PRICE_TIERS,
                                 REFERENCE_SCORE_WEIGHTS, add_parts, double_parts, guarded_ratio,
                                 parts_avg, summed_parts, tier, weighted_score)
from ..functions.timestamps import ts_lit
from ..operators.rank import dense_ranks, global_position, top_n, with_percentiles
from ..session import materialize

STAR_COLUMNS = [
    "condition_name", "condition_category", "drug_name", "drug_type", "drug_form",
    "drug_avg_price", "effectiveness_score", "ease_of_use_score", "satisfaction_score",
    "review_count", "price",
]

# ---------------------------------------------------------------------------
# Type and form vocabularies of the original summary mart.
REFERENCE_RX_TYPES = ["RX"]
REFERENCE_OTC_TYPES = ["OTC", "RX/OTC"]
REFERENCE_FORM_GROUPS = {
    "tablet_options": ["Tablet", "Capsule"],
    "liquid_options": ["Liquid"],
    "topical_options": ["Cream", "Gel", "Ointment"],
    "injectable_options": ["Injectable"],
}
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class MartSpec:
    """Parameters of the three marts; defaults are the original pipeline's."""

    weights: dict = field(default_factory=lambda: dict(REFERENCE_SCORE_WEIGHTS))
    score_scale: int = 2
    reweight_missing: bool = False
    price_tiers: tuple = tuple(REFERENCE_PRICE_TIERS)
    price_tier_top: str = REFERENCE_PRICE_TIER_TOP
    value_factor: float = 100.0
    value_scale: int = 4
    rx_types: tuple = tuple(REFERENCE_RX_TYPES)
    otc_types: tuple = tuple(REFERENCE_OTC_TYPES)
    form_groups: dict = field(default_factory=lambda: {k: list(v) for k, v in
                                                       REFERENCE_FORM_GROUPS.items()})
    run_ts: datetime | None = None  # when set, marts carry ``last_updated``
    # Counts of the original count fact rows; with ``distinct_counts`` the
    # marts also carry distinct item / group counts.
    distinct_counts: bool = False
    # "row": best item = the single best fact row (original); "mean": the item
    # with the best mean score, consistent with the ranking mart.
    best_by: str = "row"


_GRAIN = ["condition_name", "condition_category", "drug_name", "drug_type", "drug_form"]
_MEASURES = {"e": "effectiveness_score", "u": "ease_of_use_score", "s": "satisfaction_score"}


def _price() -> Column:
    """Fact price, else the item's average price."""
    return F.coalesce(F.col("price"), F.col("drug_avg_price"))


def _mean(prefix: str) -> Column:
    """Finish an average from composable parts: one division in double."""
    return parts_avg(add_parts(prefix))


def _sums(price: Column) -> list[Column]:
    return [*[a for k, c in _MEASURES.items() for a in summed_parts(c, k)],
            *summed_parts(price, "p"),
            F.min(price).alias("p_min"), F.max(price).alias("p_max"),
            F.sum(F.coalesce(F.col("review_count"), F.lit(0))).alias("reviews"),
            F.count(F.lit(1)).alias("n_rows"),
            F.max("effectiveness_score").alias("e_max")]


def base(star: DataFrame, spec: MartSpec = MartSpec()) -> DataFrame:
    """Finest-grain partial aggregate of the star, from which all three marts derive.

    One row per (group, category, item, type, form) with the parts of exact sums
    and counts, min/max price, review total, row counts and the best score.
    Every part composes (sums of sums, min of mins), so the marts re-aggregate
    this small table instead of scanning and shuffling the star three times.
    All buffers are fixed-width, so Spark hash-aggregates (a struct-valued
    ``min`` here would force a sort-based aggregate over every fact row), and
    map-side partial aggregation bounds what a hot group ships.
    """
    return (star.groupBy(*_GRAIN)
            .agg(*_sums(_price()),
                 F.count("drug_name").alias("n_item"),
                 F.count("condition_name").alias("n_group")))


def base_of_fact(fact: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """``base`` of the star of a fact and its dimensions, without joining the fact.

    Type, form and average price belong to the item, name and category to the
    group, so the fact is aggregated by its two keys first and only that result
    meets the dimensions. Facts without a price count with the item's average:
    as many times its parts, which are whole numbers, as there are such facts.
    """
    return base_of_partials(fact_partials(fact), items, groups)


def fact_partials(fact: DataFrame) -> DataFrame:
    """The fact aggregated by its two keys: parts that add up across any cut of its rows."""
    return (fact.groupBy("drug_key", "condition_key")
            .agg(*_sums(F.col("price")), F.count(F.when(F.col("price").isNull(), 1)).alias("unpriced")))


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of several cuts of a fact as those of the whole."""
    sums = [c for c in partials.columns if c not in ("drug_key", "condition_key", "p_min", "p_max", "e_max")]
    return partials.groupBy("drug_key", "condition_key").agg(
        *(F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in sums),
        F.min("p_min").alias("p_min"), F.max("p_max").alias("p_max"), F.max("e_max").alias("e_max"))


def base_of_partials(own: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """The marts' pre-aggregate from ``fact_partials`` and the dimensions."""
    f, d, g = own.alias("f"), items.alias("d"), groups.alias("g")
    joined = (f.join(d, F.col("f.drug_key") == F.col("d.drug_key"))
              .join(g, F.col("f.condition_key") == F.col("g.condition_key"))
              .select("f.*", "g.condition_name", "g.condition_category", "d.drug_name", "d.drug_type",
                      "d.drug_form", F.col("d.average_price").alias("item_price")))
    parts = double_parts("item_price")
    filled = F.col("unpriced") > 0

    def more(k: str) -> Column:
        if k == "sx":                       # not finite, or huge: any share of it shows
            return F.when(filled, parts[k] * F.col("unpriced"))
        return F.coalesce(parts[k], F.lit(0)) * F.col("unpriced")

    def typed(k: str, c: Column) -> Column:
        return c.cast("decimal(38,0)") if k == "s0" else c

    price = {f"p_{k}": typed(k, F.when(F.col(f"p_{k}").isNull() & more(k).isNull(), None)
                             .otherwise(F.coalesce(F.col(f"p_{k}"), F.lit(0)) + F.coalesce(more(k), F.lit(0))))
             for k in PARTS}
    own_price = F.when(filled, F.col("item_price"))
    price |= {"p_min": F.least("p_min", own_price), "p_max": F.greatest("p_max", own_price),
              "n_item": F.when(F.col("drug_name").isNotNull(), F.col("n_rows")).otherwise(0),
              "n_group": F.when(F.col("condition_name").isNotNull(), F.col("n_rows")).otherwise(0)}
    return joined.withColumns(price).drop("drug_key", "condition_key", "unpriced", "item_price")


def _stamp(df: DataFrame, spec: MartSpec) -> DataFrame:
    if spec.run_ts is None:
        return df
    return df.withColumn("last_updated", ts_lit(spec.run_ts))


def ranking(star: DataFrame, spec: MartSpec = MartSpec(), from_base: bool = False) -> DataFrame:
    """Per (group, item, type, form): mean scores, weighted score and three dense ranks.

    The scored rows are written once: the ranks read them for their sort and
    again for the join of the ranks.
    """
    b = star if from_base else base(star, spec)
    agg = (b.groupBy("condition_name", "drug_name", "drug_type", "drug_form")
           .agg(_mean("e").alias("effectiveness_score"),
                _mean("u").alias("ease_of_use_score"),
                _mean("s").alias("satisfaction_score"),
                F.sum("reviews").alias("total_reviews"),
                _mean("p").alias("average_price"))
           .withColumn("overall_score",
                       weighted_score(spec.weights, spec.score_scale, spec.reweight_missing)))
    ranked = dense_ranks(materialize(agg, "scored"), ["condition_name"], {
        "effectiveness_rank": "effectiveness_score",
        "satisfaction_rank": "satisfaction_score",
        "overall_rank": "overall_score",
    })
    cols = ["condition_name", "drug_name", "drug_type", "drug_form",
            "effectiveness_score", "ease_of_use_score", "satisfaction_score", "overall_score",
            "effectiveness_rank", "satisfaction_rank", "overall_rank",
            "total_reviews", "average_price"]
    return _stamp(ranked.select(*cols), spec)


def value(star: DataFrame, spec: MartSpec = MartSpec(), partitions: int | None = None,
          from_base: bool = False) -> DataFrame:
    """Per (item, type): means, price tier, value score and two whole-table percentiles.

    Both percentiles come from one range sort (``with_percentiles``), never from
    a window in one task. Ties are broken by item then type so reruns agree.
    """
    b = star if from_base else base(star, spec)
    agg = (b.groupBy("drug_name", "drug_type")
           .agg(_mean("e").alias("avg_effectiveness"),
                _mean("u").alias("avg_ease_of_use"),
                _mean("s").alias("avg_satisfaction"),
                _mean("p").alias("average_price"),
                F.sum("reviews").alias("total_reviews"),
                F.sum("n_group").alias("conditions_treated"),
                *([F.count_distinct("condition_name").alias("distinct_conditions_treated")]
                  if spec.distinct_counts else []))
           .filter(F.col("average_price").isNotNull())
           .withColumn("price_tier", tier("average_price", list(spec.price_tiers),
                                          spec.price_tier_top))
           .withColumn("value_score", guarded_ratio("avg_effectiveness", "average_price",
                                                    spec.value_factor, spec.value_scale)))
    out = with_percentiles(materialize(agg, "valued"), ["drug_name", "drug_type"], {
        "price_percentile": ("average_price", False),
        "performance_percentile": ("avg_effectiveness", True),
    }, partitions)
    cols = ["drug_name", "drug_type", "price_tier", "average_price", "avg_effectiveness",
            "avg_ease_of_use", "avg_satisfaction", "value_score", "price_percentile",
            "performance_percentile", "total_reviews", "conditions_treated"]
    if spec.distinct_counts:
        cols.append("distinct_conditions_treated")
    return _stamp(out.select(*cols), spec)


def summary(star: DataFrame, spec: MartSpec = MartSpec(), from_base: bool = False) -> DataFrame:
    """Per group: conditional counts, means, price range and the best item, in ONE aggregate.

    The best item is the row with the highest effectiveness (nulls last, ties
    by item name): the minimum of an ordering struct over the pre-aggregate's
    per-item maxima, an aggregate over small data, so no window and no join.
    """
    b = star if from_base else base(star, spec)
    t, f, n = F.col("drug_type"), F.col("drug_form"), F.col("n_rows")

    def rows_where(pred: Column) -> Column:
        return F.sum(F.when(pred, n).otherwise(F.lit(0)))

    forms = [rows_where(f.isin(list(v))).alias(k) for k, v in spec.form_groups.items()]
    if spec.best_by == "row":
        # best single row = the item with the highest per-item maximum
        best_item = F.min(F.struct(F.col("e_max").isNull(), -F.col("e_max"),
                                   F.col("drug_name"))).getField("drug_name")
    elif spec.best_by == "mean":
        best_item = F.min(F.struct(F.col("item_mean").isNull(), -F.col("item_mean"),
                                   F.col("drug_name"))).getField("drug_name")
        item_mean = (b.groupBy("condition_name", "drug_name")
                     .agg(_mean("e").alias("item_mean")))
        b = b.join(item_mean, ["condition_name", "drug_name"], "left")
    else:
        raise ValueError("best_by must be 'row' or 'mean'")
    out = (b.groupBy("condition_name", "condition_category")
           .agg(F.sum("n_item").alias("total_drugs_available"),
                rows_where(t.isin(list(spec.rx_types))).alias("rx_drugs_count"),
                rows_where(t.isin(list(spec.otc_types))).alias("otc_drugs_count"),
                *forms,
                _mean("e").alias("avg_effectiveness"),
                _mean("s").alias("avg_satisfaction"),
                best_item.alias("best_drug_by_effectiveness"),
                *([F.count_distinct("drug_name").alias("distinct_drugs_available")]
                  if spec.distinct_counts else []),
                F.min("p_min").alias("min_price"),
                F.max("p_max").alias("max_price"),
                _mean("p").alias("avg_price"),
                F.sum("reviews").alias("total_patient_reviews")))
    cols = ["condition_name", "condition_category", "total_drugs_available", "rx_drugs_count",
            "otc_drugs_count", *spec.form_groups.keys(), "avg_effectiveness",
            "avg_satisfaction", "best_drug_by_effectiveness", "min_price", "max_price",
            "avg_price", "total_patient_reviews"]
    if spec.distinct_counts:
        cols.append("distinct_drugs_available")
    return _stamp(out.select(*cols), spec)


def all_marts(star: DataFrame, spec: MartSpec = MartSpec(), partitions: int | None = None
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three marts from one pass over the star.

    The pre-aggregate is written once under the session's checkpoint folder:
    it is small, read three times, and cuts the star's lineage so a lost
    executor never forces the star join to rerun.
    """
    return marts_of_base(materialize(base(star, spec), "mart_base"), spec, partitions)


def marts_of_base(b: DataFrame, spec: MartSpec = MartSpec(), partitions: int | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three marts from a written pre-aggregate."""
    return (ranking(b, spec, from_base=True), value(b, spec, partitions, from_base=True),
            summary(b, spec, from_base=True))


# --- read queries on the marts (the user SQL of the original) ---------------------

def best_in_group(ranking_mart: DataFrame, n: int = 5, groups: Sequence[str] | None = None,
                  position: str | None = None) -> DataFrame:
    """Items with ``overall_rank <= n`` (a filter on the stored rank, pushed to the scan).

    Ordered by group and rank; with ``position`` a column of that name holds the place in
    this order (``rank.global_position``: any number of ties, none of them on the driver).
    """
    df = ranking_mart
    if groups is not None:
        df = df.filter(F.col("condition_name").isin(list(groups)))
    order = ["condition_name", "overall_rank", "drug_name", "drug_type", "drug_form"]
    kept = ["condition_name", "drug_name", "overall_score", "overall_rank", "total_reviews", "average_price"]
    df = df.filter(F.col("overall_rank") <= n)
    if position:
        return global_position(df, order, position, total=None).select(position, *kept)
    return df.select(*kept, "drug_type", "drug_form").orderBy(*order).select(*kept)


def best_value_in_tier(value_mart: DataFrame, n: int = 10,
                       tiers: Sequence[str] | None = None) -> DataFrame:
    """Top ``n`` items by value score within each price tier (ties by item, type)."""
    df = value_mart
    if tiers is not None:
        df = df.filter(F.col("price_tier").isin(list(tiers)))
    order = [F.col("value_score").desc_nulls_last(), F.col("drug_name").asc_nulls_first(),
             F.col("drug_type").asc_nulls_first()]
    return (top_n(df, ["price_tier"], order, n, rank_col="value_rank")
            .select("price_tier", "value_rank", "drug_name", "drug_type", "average_price",
                    "avg_effectiveness", "value_score"))


def group_leaderboard(summary_mart: DataFrame, position: str | None = None) -> DataFrame:
    """Groups by total reviews, most reviewed first; with ``position`` also numbered so."""
    order = [F.col("total_patient_reviews").desc_nulls_last(), F.col("condition_name")]
    board = summary_mart.select("condition_name", "total_drugs_available", "rx_drugs_count",
                                "otc_drugs_count", "best_drug_by_effectiveness", "avg_price",
                                "total_patient_reviews")
    return global_position(board, order, position, total=None) if position else board.orderBy(*order)
