"""Driver-table analogs: the star, feeds and snapshots derived from the TPC-H-like tables.

The marts and dimension jobs are generic over a column contract; these
functions map the shared test tables onto that contract so every registered
query reads the whole tables and its work grows with them. Each has an SQL
twin in ``__spark_entry__`` for the DuckDB oracle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleanse import categorise, leading_int

# ---------------------------------------------------------------------------
# Fixed values of the analog (not of the original pipeline): keyword rules over
# market segments, the vocabularies the summary mart counts, price tier limits
# that split the analog's item prices in thirds, and the yearly dimension loads.
SEGMENT_RULES = [("Industrial", ["machinery", "building"]),
                 ("Consumer", ["household", "furniture"])]
ANALOG_RX_TYPES = ["A"]
ANALOG_OTC_TYPES = ["N", "R"]
ANALOG_FORM_GROUPS = {
    "tablet_options": ["SMALL", "MEDIUM"],
    "liquid_options": ["LARGE"],
    "topical_options": ["PROMO", "ECONOMY"],
    "injectable_options": ["STANDARD"],
}
ANALOG_PRICE_TIERS = [(25000.0, "Low"), (28000.0, "Medium")]
ANALOG_PRICE_TIER_TOP = "High"
# Item-name keyword rules; "Age" comes before "Thermal", so "cold" hits "old".
NAME_RULES = [("Size", ["small", "large"]), ("Age", ["old", "new"]),
              ("Thermal", ["hot", "cold"]), ("Colour", ["blue", "red"])]
# Three loads that cut all line items by ship date: before 1997, 1997 to 1998, from 1999 on.
LOADS = [(None, date(1997, 1, 1)), (date(1997, 1, 1), date(1999, 1, 1)), (date(1999, 1, 1), None)]
EVERYTHING = (None, None)
LAST_LOAD = date(2002, 1, 1)
# ---------------------------------------------------------------------------


def total_sql(x: str) -> str:
    """The exact total of ``functions.scoring`` in DuckDB: whole-number parts summed, put together once."""
    part = f"(CASE WHEN NOT abs({x}) >= 4611686018427387904.0 THEN {x} END)"
    # what is left behind a place is the value less its whole multiples of that place, which is exact
    def behind(k: int) -> str:
        return f"({part} * power(2.0::DOUBLE, {20 * k}) - trunc({part} * power(2.0::DOUBLE, {20 * k})))"
    cuts = [f"coalesce(SUM(CAST(trunc({part}) AS BIGINT)), 0)::DOUBLE"]
    cuts += [f"coalesce(SUM(CAST(trunc({behind(k)} * 1048576.0::DOUBLE) AS BIGINT)), 0)::DOUBLE" for k in range(4)]
    low = f"coalesce(SUM({behind(4)} * power(2.0::DOUBLE, -80)), 0.0::DOUBLE)"
    for k in (4, 3, 2, 1):
        low = f"({cuts[k]} * power(2.0::DOUBLE, {-20 * k}) + {low})"
    huge = f"coalesce(SUM(CASE WHEN abs({x}) >= 4611686018427387904.0 THEN {x} END), 0.0::DOUBLE)"
    return f"({huge} + ({cuts[0]} + {low}))"


def avg_sql(x: str) -> str:
    return f"(CASE WHEN COUNT({x}) > 0 THEN {total_sql(x)} / COUNT({x}) END)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def review_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, in the star contract of ``plans.marts``."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity",
        "l_discount", "l_tax", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    # per-order and per-customer derivations run on those (smaller) tables, not per line item
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", leading_int("o_orderpriority").alias("review_count"))
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment",
        categorise("c_mktsegment", SEGMENT_RULES).alias("condition_category"))
    # orders x customer first: the smaller pair, then one join with the line items
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey)
    joined = (li.join(part, li.l_partkey == part.p_partkey)
              .join(oc, li.l_orderkey == oc.o_orderkey))
    return joined.select(
        F.col("c_mktsegment").alias("condition_name"),
        F.col("condition_category"),
        F.col("p_name").alias("drug_name"),
        F.col("l_returnflag").alias("drug_type"),
        F.col("p_type").alias("drug_form"),
        F.col("p_retailprice").alias("drug_avg_price"),
        F.col("l_quantity").alias("effectiveness_score"),
        F.col("l_discount").alias("ease_of_use_score"),
        F.col("l_tax").alias("satisfaction_score"),
        F.col("review_count"),
        F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("price"),
    )


STAR_SQL = """
SELECT c_mktsegment AS condition_name,
       CASE WHEN lower(c_mktsegment) LIKE '%machinery%' OR lower(c_mktsegment) LIKE '%building%'
            THEN 'Industrial'
            WHEN lower(c_mktsegment) LIKE '%household%' OR lower(c_mktsegment) LIKE '%furniture%'
            THEN 'Consumer' ELSE 'Other' END AS condition_category,
       p_name AS drug_name, l_returnflag AS drug_type, p_type AS drug_form,
       p_retailprice AS drug_avg_price,
       l_quantity AS effectiveness_score, l_discount AS ease_of_use_score,
       l_tax AS satisfaction_score,
       TRY_CAST(regexp_extract(o_orderpriority, '^([0-9]+)', 1) AS INTEGER) AS review_count,
       CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS price
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""


def analog_mart_spec(**kw):
    from .marts import MartSpec
    return MartSpec(rx_types=tuple(ANALOG_RX_TYPES), otc_types=tuple(ANALOG_OTC_TYPES),
                    form_groups={k: list(v) for k, v in ANALOG_FORM_GROUPS.items()},
                    price_tiers=tuple(ANALOG_PRICE_TIERS), price_tier_top=ANALOG_PRICE_TIER_TOP,
                    **kw)


# --- item dimension snapshots for the SCD2 queries ----------------------------------
# One snapshot per load: the items shipped in its span with their attributes as
# the feed shows them (type = highest return flag seen, price = mean billed price
# of finished lines, null when none). From load to load the attributes change,
# items appear and items vanish, as a re-aggregated feed does. The spans together
# read every line item.

ITEM_SCD2_KEYS = ("item_key",)
ITEM_SCD2_TRACKED = ("average_price", "item_type", "item_form")


def _ts(d: date) -> F.Column:
    return F.lit(d.isoformat() + " 00:00:00").cast("timestamp_ntz")


def item_snapshot(spark: SparkSession, sf_dir: str, span: tuple[date | None, date | None]) -> DataFrame:
    from ..functions.scoring import add_parts, parts_avg, summed_parts
    lo, hi = span
    li = table(spark, sf_dir, "lineitem")
    if lo:
        li = li.filter(F.col("l_shipdate") >= _ts(lo))
    if hi:
        li = li.filter(F.col("l_shipdate") < _ts(hi))
    finished = F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice"))
    # text max has no fixed-width buffer (Spark would sort every line item to
    # aggregate it): hash-aggregate per (item, flag) first, then take the max
    # flag and finish the exact average over that small result
    per_flag = li.groupBy("l_partkey", "l_returnflag").agg(
        *summed_parts(finished, "p"))
    per_item = per_flag.groupBy("l_partkey").agg(
        F.max("l_returnflag").alias("item_type"),
        parts_avg(add_parts("p")).alias("average_price"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return per_item.join(part, per_item.l_partkey == part.p_partkey).select(
        F.col("p_partkey").alias("item_key"), F.col("p_name").alias("item_name"),
        F.col("item_type"), F.col("p_type").alias("item_form"), F.col("average_price"))


def item_snapshot_sql(span: tuple[date | None, date | None]) -> str:
    lo, hi = span
    spans = [*([f"l_shipdate >= TIMESTAMP '{lo} 00:00:00'"] if lo else []),
             *([f"l_shipdate < TIMESTAMP '{hi} 00:00:00'"] if hi else [])]
    where = f"WHERE {' AND '.join(spans)}" if spans else ""
    fin = "CASE WHEN l_linestatus = 'F' THEN l_extendedprice END"
    return f"""
SELECT p_partkey AS item_key, p_name AS item_name, a.item_type, p_type AS item_form,
       a.average_price
FROM (SELECT l_partkey, MAX(l_returnflag) AS item_type,
             {avg_sql(fin)} AS average_price
      FROM lineitem
      {where}
      GROUP BY l_partkey) a
JOIN part ON a.l_partkey = p_partkey"""


def load_date(span: tuple[date | None, date | None]) -> date:
    """A load runs on the day its span ends."""
    return span[1] or LAST_LOAD


# --- two review feeds for the silver layer -------------------------------------------
# Finished lines feed the text-only "raw" feed, open lines the typed "clean"
# feed, with the padding, letter case and missing labels real feeds carry.

FEED_RUN_TS = "2024-02-01 00:00:00"


def feed_source(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Line items with their part and order: the extract both feeds are cut from.

    With ``status`` only that line status is read (pushed to the scan);
    without it both feeds can be cut from one join (see ``silver_feeds``).
    """
    li = table(spark, sf_dir, "lineitem")
    if status is not None:
        li = li.filter(F.col("l_linestatus") == status)
    li = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus",
                   "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus",
                                                   "o_orderpriority")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .join(orders, li.l_orderkey == orders.o_orderkey))


def silver_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both feeds from ONE join of the line items, written once and split by status."""
    from ..session import materialize
    src = materialize(feed_source(spark, sf_dir), "feed_source")
    return raw_feed(spark, sf_dir, src), clean_feed(spark, sf_dir, src)


def _type_label(blank_when: F.Column, padded: bool) -> F.Column:
    f = F.col("l_returnflag")
    return (F.when(blank_when, F.lit(None))
            .when(f == "A", F.lit("RX"))
            .when(f == "N", F.lit(" OTC " if padded else "OTC"))
            .otherwise(F.lit("RX/OTC")))


def raw_feed(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    f = F.col("l_returnflag")
    b = (feed_source(spark, sf_dir, "F") if source is None
         else source.filter(F.col("l_linestatus") == "F"))
    return b.select(
        F.when(f == "A", F.upper("p_name")).when(f == "N", F.concat(F.lit("  "), "p_name",
                                                                    F.lit(" ")))
        .otherwise(F.col("p_name")).alias("condition"),
        F.when(f == "R", F.concat(F.lit(" "), "p_brand")).otherwise(F.col("p_brand"))
        .alias("drug"),
        F.col("o_orderstatus").alias("indication"),
        _type_label(F.col("l_discount") == 0, padded=True).alias("type"),
        F.col("o_orderpriority").alias("reviews"),
        F.col("l_quantity").cast("string").alias("effective"),
        F.col("l_discount").cast("string").alias("ease_of_use"),
        F.col("l_tax").cast("string").alias("satisfaction"),
        F.col("p_type").alias("information"),
    )


def clean_feed(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    f = F.col("l_returnflag")
    b = (feed_source(spark, sf_dir, "O") if source is None
         else source.filter(F.col("l_linestatus") == "O"))
    return b.select(
        F.when(f == "R", F.lower("p_name")).otherwise(F.col("p_name")).alias("condition"),
        F.col("p_brand").alias("drug"),
        F.col("l_discount").alias("ease_of_use"),
        F.col("l_quantity").alias("effective"),
        F.col("p_type").alias("form"),
        F.col("o_orderstatus").alias("indication"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").cast("double").alias("reviews"),
        F.col("l_tax").alias("satisfaction"),
        _type_label(F.col("l_tax") == 0, padded=False).alias("type"),
    )


_FEED_FROM = """FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey"""

RAW_FEED_SQL = f"""
SELECT CASE WHEN l_returnflag = 'A' THEN upper(p_name)
            WHEN l_returnflag = 'N' THEN concat('  ', p_name, ' ') ELSE p_name END AS condition,
       CASE WHEN l_returnflag = 'R' THEN concat(' ', p_brand) ELSE p_brand END AS drug,
       o_orderstatus AS indication,
       CASE WHEN l_discount = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'RX'
            WHEN l_returnflag = 'N' THEN ' OTC ' ELSE 'RX/OTC' END AS type,
       o_orderpriority AS reviews,
       CAST(l_quantity AS VARCHAR) AS effective, CAST(l_discount AS VARCHAR) AS ease_of_use,
       CAST(l_tax AS VARCHAR) AS satisfaction, p_type AS information
{_FEED_FROM} WHERE l_linestatus = 'F'"""

CLEAN_FEED_SQL = f"""
SELECT CASE WHEN l_returnflag = 'R' THEN lower(p_name) ELSE p_name END AS condition,
       p_brand AS drug, l_discount AS ease_of_use, l_quantity AS effective, p_type AS form,
       o_orderstatus AS indication, l_extendedprice AS price,
       CAST(l_linenumber AS DOUBLE) AS reviews, l_tax AS satisfaction,
       CASE WHEN l_tax = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'RX'
            WHEN l_returnflag = 'N' THEN 'OTC' ELSE 'RX/OTC' END AS type
{_FEED_FROM} WHERE l_linestatus = 'O'"""


# --- event feed: quality rules and first-seen carry ------------------------------------
# Fixed values of the analog: the rules (name -> SQL predicate, TRUE = good row)
# and the two loads of the first-seen dimension (cut-off, run time).
EVENT_RULES_SQL = {
    "value_at_least_1": "value >= 1",
    "not_error": "event_type <> 'error'",
    "props_has_key": "props LIKE '%\"k\"%'",
}
FIRST_SEEN_CUTOFF = "2024-01-08 00:00:00"
FIRST_SEEN_RUNS = ("2024-01-08 00:00:00", "2024-02-01 00:00:00")


def event_rules() -> dict:
    return {n: F.expr(p) for n, p in EVENT_RULES_SQL.items()}


def event_activity(events: DataFrame) -> DataFrame:
    """Per (user, event type): number of events and total value (exact sum)."""
    from ..functions.scoring import exact_total
    return (events.groupBy("user_id", "event_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 exact_total("value").alias("total_value")))


# --- CSV files of the two feeds, for the end-to-end pipeline ------------------------------

def dirty_feeds(raw: DataFrame, clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both feeds with the faults a real one carries: a missing name, a line break inside
    a label, NaN as text, a price that is no number, a fractional count."""
    raw = (raw.withColumn("drug", F.when(F.col("ease_of_use") == "0.03", F.lit(None)).otherwise(F.col("drug")))
           .withColumn("type", F.when(F.col("satisfaction") == "0.05", F.concat("type", F.lit("\r\n")))
                       .otherwise(F.col("type")))
           .withColumn("effective", F.when(F.col("ease_of_use") == "0.07", F.lit("NaN"))
                       .otherwise(F.col("effective"))))
    clean = (clean.withColumn("price", F.when(F.col("ease_of_use") == 0.03, F.lit("abc"))
                              .otherwise(F.col("price").cast("string")))
             .withColumn("reviews", F.when(F.col("reviews") == 3, F.lit("3.7"))
                         .otherwise(F.col("reviews").cast("string")))
             .withColumn("condition", F.when(F.col("satisfaction") == 0.07, F.lit(None))
                         .otherwise(F.col("condition"))))
    return raw, clean


#: Fixed values of the analog: which raw records get a field too many, and which a quote that is never closed
EXTRA_FIELD, OPEN_QUOTE = "0.04", "0.06"


def write_broken_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The raw feed as plain lines without quoting, some of which no parser can cut into its columns."""
    raw = raw_feed(spark, sf_dir)
    broken = (raw.withColumn("information", F.when(F.col("ease_of_use") == EXTRA_FIELD, F.concat("information", F.lit(",x")))
                             .otherwise(F.col("information")))
              .withColumn("indication", F.when(F.col("satisfaction") == OPEN_QUOTE, F.concat(F.lit('"'), "indication"))
                          .otherwise(F.col("indication"))))
    # a line is one value of a writer that has another separator and quote, under the feed's own header
    line = F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in broken.columns)).alias(",".join(broken.columns))
    (broken.select(line).write.options(header="true", sep="\u0001", quote="\u0002", ignoreLeadingWhiteSpace="false",
                                       ignoreTrailingWhiteSpace="false").csv(path))


def write_feed_csvs(spark: SparkSession, sf_dir: str, root: str,
                    raw_name: str = "Drug.csv", clean_name: str = "Drug_clean.csv",
                    dirty: bool = False) -> None:
    """Write both feeds as CSV folders under ``root`` (the pipeline's volume)."""
    from ..sources.csv import CSV_OPTIONS
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "mode")}
    raw, clean = silver_feeds(spark, sf_dir)
    if dirty:
        raw, clean = dirty_feeds(raw, clean)
    for df, name in [(raw, raw_name), (clean, clean_name)]:
        df.write.mode("overwrite").options(**opts).csv(f"{root}/{name}")
