"""

``queries()`` maps a name to a callable (spark, sf_dir) -> DataFrame over the
shared test tables; ``oracle_sql()`` gives the same result as DuckDB SQL over
views of those tables. Both sides alias every computed column identically.

Layout: the SQL twins come first (building blocks, then one builder per query
family), the Spark queries after them. Oracle conventions, so that doubles agree
bit for bit: averages are exact sums divided once; HALF_UP rounding goes through
the value's shortest text (as Spark rounds); wide decimals convert through text;
casts to integer truncate; NULLS FIRST/LAST is always spelled out; every
row_number has a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.operators import quality, scd2
from strata.functions.keys import with_lineage
from strata.plans import analogs, marts, star

try:  # the training-data operators may be absent; nothing else depends on them
    import corpus_pipeline
    from strata.llm import queries as llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "strata.llm", "strata.llm.queries"):
        raise
    corpus_pipeline = llm = None

SF_SMOKE = "/root/testdata/sf0.001"


# --- SQL building blocks for the oracle -------------------------------------------

def _r(x: str, k: int) -> str:
    """HALF_UP rounding of a double as Spark does it (through its shortest text)."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {k}) AS DOUBLE)"


_avg = analogs.avg_sql


_PRICE = "COALESCE(price, drug_avg_price)"


def _ranking_sql() -> str:
    score = (f"COALESCE(effectiveness_score, 0) * CAST(0.4 AS DOUBLE)"
             f" + COALESCE(satisfaction_score, 0) * CAST(0.4 AS DOUBLE)"
             f" + COALESCE(ease_of_use_score, 0) * CAST(0.2 AS DOUBLE)")
    return f"""
WITH star AS ({analogs.STAR_SQL}),
agg AS (
  SELECT condition_name, drug_name, drug_type, drug_form,
         {_avg('effectiveness_score')} AS effectiveness_score,
         {_avg('ease_of_use_score')} AS ease_of_use_score,
         {_avg('satisfaction_score')} AS satisfaction_score,
         CAST(SUM(COALESCE(review_count, 0)) AS BIGINT) AS total_reviews,
         {_avg(_PRICE)} AS average_price
  FROM star GROUP BY condition_name, drug_name, drug_type, drug_form),
scored AS (SELECT *, {_r(score, 2)} AS overall_score FROM agg)
SELECT condition_name, drug_name, drug_type, drug_form,
       effectiveness_score, ease_of_use_score, satisfaction_score, overall_score,
       CAST(DENSE_RANK() OVER (PARTITION BY condition_name
            ORDER BY effectiveness_score DESC NULLS LAST) AS INTEGER) AS effectiveness_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY condition_name
            ORDER BY satisfaction_score DESC NULLS LAST) AS INTEGER) AS satisfaction_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY condition_name
            ORDER BY overall_score DESC NULLS LAST) AS INTEGER) AS overall_rank,
       total_reviews, average_price
FROM scored"""


def _value_sql() -> str:
    tiers = " ".join(f"WHEN average_price < {lim} THEN '{name}'"
                     for lim, name in analogs.ANALOG_PRICE_TIERS)
    ratio = ("CASE WHEN average_price > 0 THEN COALESCE(avg_effectiveness, 0) / average_price"
             " * CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END")
    ties = "drug_name ASC NULLS FIRST, drug_type ASC NULLS FIRST"
    return f"""
WITH star AS ({analogs.STAR_SQL}),
agg AS (
  SELECT drug_name, drug_type,
         {_avg('effectiveness_score')} AS avg_effectiveness,
         {_avg('ease_of_use_score')} AS avg_ease_of_use,
         {_avg('satisfaction_score')} AS avg_satisfaction,
         {_avg(_PRICE)} AS average_price,
         CAST(SUM(COALESCE(review_count, 0)) AS BIGINT) AS total_reviews,
         COUNT(condition_name) AS conditions_treated
  FROM star GROUP BY drug_name, drug_type),
pos AS (
  SELECT *, CASE {tiers} ELSE '{analogs.ANALOG_PRICE_TIER_TOP}' END AS price_tier,
         {_r(ratio, 4)} AS value_score,
         ROW_NUMBER() OVER (ORDER BY average_price ASC NULLS FIRST, {ties}) AS p_pos,
         ROW_NUMBER() OVER (ORDER BY avg_effectiveness DESC NULLS LAST, {ties}) AS e_pos,
         COUNT(*) OVER () AS n
  FROM agg WHERE average_price IS NOT NULL)
SELECT drug_name, drug_type, price_tier, average_price, avg_effectiveness, avg_ease_of_use,
       avg_satisfaction, value_score,
       CAST({_r('p_pos / n * CAST(100 AS DOUBLE)', 0)} AS INTEGER) AS price_percentile,
       CAST({_r('e_pos / n * CAST(100 AS DOUBLE)', 0)} AS INTEGER) AS performance_percentile,
       total_reviews, conditions_treated
FROM pos"""


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _summary_sql() -> str:
    forms = ",\n".join(f"         COUNT(*) FILTER (WHERE drug_form IN {_in(v)}) AS {k}"
                       for k, v in analogs.ANALOG_FORM_GROUPS.items())
    return f"""
WITH star AS ({analogs.STAR_SQL})
SELECT condition_name, condition_category,
       COUNT(drug_name) AS total_drugs_available,
       COUNT(*) FILTER (WHERE drug_type IN {_in(analogs.ANALOG_RX_TYPES)}) AS rx_drugs_count,
       COUNT(*) FILTER (WHERE drug_type IN {_in(analogs.ANALOG_OTC_TYPES)}) AS otc_drugs_count,
{forms},
       {_avg('effectiveness_score')} AS avg_effectiveness,
       {_avg('satisfaction_score')} AS avg_satisfaction,
       arg_min(drug_name, struct_pack(a := effectiveness_score IS NULL,
               b := -effectiveness_score, c := drug_name)) AS best_drug_by_effectiveness,
       MIN({_PRICE}) AS min_price, MAX({_PRICE}) AS max_price, {_avg(_PRICE)} AS avg_price,
       CAST(SUM(COALESCE(review_count, 0)) AS BIGINT) AS total_patient_reviews
FROM star GROUP BY condition_name, condition_category"""


def _best_in_group_sql() -> str:
    return f"""
WITH r AS ({_ranking_sql()})
SELECT condition_name, drug_name, overall_score, overall_rank, total_reviews, average_price
FROM r WHERE overall_rank <= 5"""


def _best_value_in_tier_sql() -> str:
    return f"""
WITH v AS ({_value_sql()}),
k AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY price_tier ORDER BY value_score DESC
        NULLS LAST, drug_name ASC NULLS FIRST, drug_type ASC NULLS FIRST) AS INTEGER) AS value_rank
      FROM v)
SELECT price_tier, value_rank, drug_name, drug_type, average_price, avg_effectiveness, value_score
FROM k WHERE value_rank <= 10"""


def _lookup_sqls() -> dict[str, str]:
    unit = "(l_extendedprice / l_quantity)"
    return {
        "global_position": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, ROW_NUMBER() OVER (ORDER BY {_LINE_ORDER}) AS position,
       COUNT(*) OVER () AS total FROM lineitem""",
        "exact_average": f"""
SELECT l_partkey, {_avg(unit)} AS avg_unit_price,
       CASE WHEN COUNT({unit}) > 0 THEN {analogs.total_sql(f"(-{unit} / 3)")} END AS third, COUNT({unit}) AS n
FROM lineitem GROUP BY l_partkey""",
        "group_lookup": f"""
WITH r AS ({_ranking_sql()})
SELECT ROW_NUMBER() OVER (ORDER BY overall_rank, drug_name, drug_type, drug_form) AS position, drug_name, overall_rank,
       overall_score, total_reviews
FROM r WHERE condition_name = 'BUILDING' AND overall_rank <= 10""",
        "tier_lookup": f"""
SELECT value_rank, drug_name, drug_type, value_score FROM ({_best_value_in_tier_sql()}) WHERE price_tier = 'Low'""",
    }


def _leaderboard_sql() -> str:
    return f"""
WITH s AS ({_summary_sql()})
SELECT condition_name, total_drugs_available, rx_drugs_count, otc_drugs_count,
       best_drug_by_effectiveness, avg_price, total_patient_reviews,
       ROW_NUMBER() OVER (ORDER BY total_patient_reviews DESC NULLS LAST, condition_name) AS position
FROM s"""


_ITEM_COLS = ["item_key", "item_name", "item_type", "item_form", "average_price"]
_SCD_SPEC = scd2.Scd2Spec(keys=analogs.ITEM_SCD2_KEYS, tracked=analogs.ITEM_SCD2_TRACKED)
_AS_OF_PROBE = "1998-06-30"


def _scd2_merge_step(hist: str, snap: str, as_of) -> str:
    """One SCD2 load in SQL: closed rows as they are; each current row once, closed if its
    item changed; a fresh row for each item that is new or changed."""
    old = ", ".join(f"o.{c}" for c in _ITEM_COLS)
    new = ", ".join(f"n.{c}" for c in _ITEM_COLS)
    tracked = analogs.ITEM_SCD2_TRACKED
    differs = (f"(n.item_key IS NOT NULL AND ({', '.join(f'n.{c}' for c in tracked)}) IS DISTINCT FROM "
               f"({', '.join(f'o.{c}' for c in tracked)}))")
    live = f"(SELECT * FROM {hist} WHERE is_current IS TRUE)"
    return f"""
  SELECT {old}, o.effective_date, CASE WHEN {differs} THEN DATE '{as_of}' ELSE o.end_date END AS end_date,
         NOT {differs} AS is_current
  FROM {live} o LEFT JOIN {snap} n USING (item_key)
  UNION ALL
  SELECT {new}, DATE '{as_of}', NULL, TRUE FROM {snap} n LEFT JOIN {live} o USING (item_key)
  WHERE o.item_key IS NULL OR {differs}
  UNION ALL
  SELECT {", ".join(_ITEM_COLS)}, effective_date, end_date, is_current FROM {hist}
  WHERE is_current IS NOT TRUE"""


def _scd2_history_sql() -> str:
    y0, y1, y2 = analogs.LOADS
    cols = ", ".join(_ITEM_COLS)
    return f"""
WITH s0 AS ({analogs.item_snapshot_sql(y0)}),
s1 AS ({analogs.item_snapshot_sql(y1)}),
s2 AS ({analogs.item_snapshot_sql(y2)}),
h0 AS (SELECT {cols}, DATE '{analogs.load_date(y0)}' AS effective_date,
              CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM s0),
h1 AS ({_scd2_merge_step('h0', 's1', analogs.load_date(y1))}),
h2 AS ({_scd2_merge_step('h1', 's2', analogs.load_date(y2))})"""


def _scd2_sqls() -> dict[str, str]:
    full = analogs.EVERYTHING
    cols = ", ".join(_ITEM_COLS)
    h = _scd2_history_sql()
    return {
        "scd2_initial": f"""
SELECT {cols}, DATE '{analogs.load_date(full)}' AS effective_date,
       CAST(NULL AS DATE) AS end_date, TRUE AS is_current
FROM ({analogs.item_snapshot_sql(full)})""",
        "scd2_merge": f"{h}\nSELECT * FROM h2",
        "scd2_versions": f"""{h},
v AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY item_key ORDER BY effective_date DESC
              NULLS LAST, end_date DESC NULLS FIRST, COALESCE(is_current, FALSE) DESC)
              AS INTEGER) AS version_number,
             COUNT(*) OVER (PARTITION BY item_key) AS version_count FROM h2)
SELECT * FROM v WHERE version_count >= 2""",
        "scd2_health": f"""{h}
SELECT COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE COALESCE(is_current, FALSE)) AS current_records,
       COUNT(DISTINCT item_key) AS unique_keys
FROM h2""",
        "scd2_as_of": f"""{h}
SELECT * FROM h2 WHERE effective_date <= DATE '{_AS_OF_PROBE}'
  AND (end_date IS NULL OR end_date > DATE '{_AS_OF_PROBE}')""",
        "scd2_closed": f"{h}\nSELECT * FROM h2 WHERE NOT COALESCE(is_current, FALSE)",
        "scd2_off": analogs.item_snapshot_sql(full),
    }


def _initcap(x: str) -> str:
    """Spark's initcap(trim(x)) in DuckDB (which has no initcap)."""
    return (f"array_to_string(list_transform(string_split(trim({x}), ' '), "
            f"lambda w: concat(upper(left(w, 1)), lower(substr(w, 2)))), ' ')")


def _label(x: str) -> str:
    return f"COALESCE(NULLIF(trim(replace({x}, chr(13) || chr(10), '')), ''), 'Unknown')"


def _rules_case(x: str, rules, otherwise: str = "Other") -> str:
    arms = []
    for cat, words in rules:
        hit = " OR ".join(f"contains(lower(COALESCE({x}, '')), '{w}')" for w in words)
        arms.append(f"WHEN {hit} THEN '{cat}'")
    return f"CASE {' '.join(arms)} ELSE '{otherwise}' END"


_RAW_COLS = ["condition", "drug", "indication", "type", "reviews", "effective", "ease_of_use",
             "satisfaction", "information"]
_CLEAN_COLS = ["condition", "drug", "ease_of_use", "effective", "form", "indication", "price",
               "reviews", "satisfaction", "type"]


def _bronze_sql(feed_sql: str, cols, source: str) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"""SELECT *, TIMESTAMP '{analogs.FEED_RUN_TS}' AS ingestion_timestamp,
       '{source}' AS source_file, md5(concat_ws('||', {parts})) AS record_id
FROM ({feed_sql})"""


def _silver_ctes() -> str:
    return f"""
raw_b AS ({_bronze_sql(analogs.RAW_FEED_SQL, _RAW_COLS, 'raw_feed')}),
clean_b AS ({_bronze_sql(analogs.CLEAN_FEED_SQL, _CLEAN_COLS, 'clean_feed')}),
raw_c AS (
  SELECT *, TRY_CAST(regexp_extract(reviews, '^([0-9]+)', 1) AS INTEGER) AS review_count,
         {_label('type')} AS drug_type_clean, {_initcap('condition')} AS condition_clean,
         trim(drug) AS drug_clean, TRY_CAST(effective AS DOUBLE) AS effective_clean,
         TRY_CAST(ease_of_use AS DOUBLE) AS ease_of_use_clean,
         TRY_CAST(satisfaction AS DOUBLE) AS satisfaction_clean
  FROM raw_b),
clean_c AS (
  SELECT *, {_label('type')} AS drug_type_clean, {_initcap('condition')} AS condition_clean,
         trim(drug) AS drug_clean, CAST(trunc(reviews) AS INTEGER) AS review_count
  FROM clean_b),
dim_items AS (
  WITH r AS (SELECT drug_clean, drug_type_clean, MIN(information) AS drug_information
             FROM raw_c GROUP BY drug_clean, drug_type_clean),
  c AS (SELECT drug_clean, drug_type_clean, form, {_avg('price')} AS average_price,
               CAST(SUM(review_count) AS BIGINT) AS total_reviews
        FROM clean_c GROUP BY drug_clean, drug_type_clean, form),
  k AS (SELECT md5(COALESCE(r.drug_clean, c.drug_clean)) AS drug_key,
               COALESCE(r.drug_clean, c.drug_clean) AS drug_name,
               COALESCE(r.drug_type_clean, c.drug_type_clean, 'Unknown') AS drug_type,
               COALESCE(c.form, 'Unknown') AS drug_form, c.average_price, r.drug_information,
               c.total_reviews
        FROM r FULL OUTER JOIN c ON r.drug_clean = c.drug_clean
                                AND r.drug_type_clean = c.drug_type_clean),
  n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY drug_key ORDER BY total_reviews DESC
               NULLS LAST, drug_type ASC NULLS FIRST, drug_form ASC NULLS FIRST) AS rn FROM k)
  SELECT drug_key, drug_name, drug_type, drug_form, average_price, drug_information
  FROM n WHERE rn = 1),
dim_groups AS (
  WITH cc AS (SELECT condition_clean, drug_clean, COALESCE(review_count, 0) AS review_count
              FROM raw_c
              UNION ALL
              SELECT condition_clean, drug_clean, COALESCE(review_count, 0) FROM clean_c),
  g AS (SELECT condition_clean, COUNT(drug_clean) AS total_drugs_available,
               CAST(SUM(review_count) AS BIGINT) AS total_reviews_count
        FROM cc GROUP BY condition_clean)
  SELECT md5(condition_clean) AS condition_key, condition_clean AS condition_name,
         {_rules_case('condition_clean', analogs.NAME_RULES)} AS condition_category,
         'Standard' AS indication_type, total_drugs_available, total_reviews_count,
         TIMESTAMP '{analogs.FEED_RUN_TS}' AS first_seen_date,
         TIMESTAMP '{analogs.FEED_RUN_TS}' AS last_updated_date
  FROM g),
fact AS (
  SELECT md5(drug_clean) AS drug_key, md5(condition_clean) AS condition_key,
         effective_clean AS effectiveness_score, ease_of_use_clean AS ease_of_use_score,
         satisfaction_clean AS satisfaction_score, review_count,
         CAST(NULL AS VARCHAR) AS drug_form, drug_type_clean AS drug_type,
         CAST(NULL AS DOUBLE) AS price, 'raw' AS data_source,
         ingestion_timestamp AS load_timestamp,
         md5(concat_ws('||', md5(drug_clean), md5(condition_clean), 'raw')) AS performance_key
  FROM raw_c
  UNION ALL
  SELECT md5(drug_clean), md5(condition_clean), effective, ease_of_use, satisfaction,
         review_count, form, drug_type_clean, price, 'clean', ingestion_timestamp,
         md5(concat_ws('||', md5(drug_clean), md5(condition_clean), 'clean'))
  FROM clean_c)"""


_CLEANSED = ["record_id", "review_count", "drug_type_clean", "condition_clean", "drug_clean"]


def _silver_sqls() -> dict[str, str]:
    w = f"WITH {_silver_ctes()}"
    raw_cols = ", ".join(_CLEANSED + ["effective_clean", "ease_of_use_clean",
                                      "satisfaction_clean"])
    clean_cols = ", ".join(_CLEANSED)
    score = (f"COALESCE(effectiveness_score, 0) * CAST(0.4 AS DOUBLE)"
             f" + COALESCE(satisfaction_score, 0) * CAST(0.4 AS DOUBLE)"
             f" + COALESCE(ease_of_use_score, 0) * CAST(0.2 AS DOUBLE)")
    return {
        "cleanse_raw": f"{w}\nSELECT {raw_cols} FROM raw_c",
        "cleanse_clean": f"{w}\nSELECT {clean_cols} FROM clean_c",
        "dim_two_feeds": f"{w}\nSELECT * FROM dim_items",
        "dim_keyword": f"{w}\nSELECT * FROM dim_groups",
        "fact_two_feeds": f"{w}\nSELECT * FROM fact",
        "silver_ranking_mart": _silver_ranking_sql(w),
        "pipeline_run": _silver_ranking_sql(w, _PIPELINE_EXTRA),
        "audit_rows": _audit_sql(w),
        "csv_roundtrip": f"""{w}
SELECT * EXCLUDE (source_file) FROM raw_b""",
        "bronze_incremental": f"""{w}
SELECT * EXCLUDE (source_file) FROM raw_b""",
        "audit_latest": f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY load_timestamp DESC NULLS LAST, layer, table_name, status) AS position
FROM ({_audit_sql(w)})""",
        "resumed_run": f"""
WITH a AS (SELECT * FROM ({_audit_sql(w)}) UNION ALL
  SELECT 'gold layer', '-', NULL, TIMESTAMP '{analogs.FEED_RUN_TS}', 'gold', 'failed', 'RuntimeError: stopped before gold')
SELECT table_name, layer, status, record_count, notes,
       ROW_NUMBER() OVER (ORDER BY load_timestamp DESC NULLS LAST, layer, table_name, status) AS position FROM a
UNION ALL SELECT * FROM (VALUES ('bronze', 'ledger', 'started', 1, '', 0), ('bronze', 'ledger', 'finished', 1, '', 0),
  ('silver', 'ledger', 'started', 1, '', 0), ('silver', 'ledger', 'finished', 1, '', 0),
  ('gold', 'ledger', 'started', 2, '', 0), ('gold', 'ledger', 'finished', 1, '', 0))""",
        "dim_unmatched_feeds": f"""{w.replace("FROM raw_b)", "FROM raw_b WHERE trim(drug) NOT LIKE '%1')")
                                    .replace("FROM clean_b)", "FROM clean_b WHERE trim(drug) NOT LIKE '%2')")}
SELECT * FROM dim_items""",
        "contract_conform": _CONFORM_SQL,
    }


_PIPELINE_EXTRA = f""",
       CAST(DENSE_RANK() OVER (PARTITION BY condition_name
            ORDER BY effectiveness_score DESC NULLS LAST) AS INTEGER) AS effectiveness_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY condition_name
            ORDER BY satisfaction_score DESC NULLS LAST) AS INTEGER) AS satisfaction_rank,
       TIMESTAMP '{analogs.FEED_RUN_TS}' AS last_updated"""

_CONFORM_SQL = """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       TRY_CAST(o_orderstatus AS INTEGER) AS o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
       CAST(NULL AS VARCHAR) AS o_comment,
       concat_ws(',', CASE WHEN o_orderstatus IS NOT NULL
                           AND TRY_CAST(o_orderstatus AS INTEGER) IS NULL
                      THEN 'o_orderstatus' END) AS cast_errors
FROM orders"""


def _audit_sql(w: str) -> str:
    ts = f"TIMESTAMP '{analogs.FEED_RUN_TS}'"
    value_groups = """(SELECT COUNT(*) FROM (SELECT drug_name, drug_type FROM star
                      GROUP BY drug_name, drug_type HAVING COUNT(COALESCE(price, drug_avg_price)) > 0))"""
    dup_keys = "(SELECT COUNT(*) FROM dup)"
    dup_rows = "(SELECT COALESCE(SUM(n), 0) FROM dup)"
    fact_status = f"CASE WHEN {dup_keys} > 0 THEN 'warning' ELSE 'success' END"
    fact_note = (f"CASE WHEN {dup_keys} > 0 THEN 'fact table; performance_key not unique: ' || "
                 f"CAST({dup_keys} AS VARCHAR) || ' keys cover ' || CAST({dup_rows} AS VARCHAR)"
                 f" || ' rows' ELSE 'fact table' END")

    def lit(x: str) -> str:
        return f"'{x}'"

    rows = [
        ("drug_reviews_raw", "Drug.csv", "(SELECT COUNT(*) FROM raw_b)", "bronze", None, "loaded"),
        ("drug_reviews_clean", "Drug_clean.csv", "(SELECT COUNT(*) FROM clean_b)", "bronze",
         None, "loaded"),
        ("drug_reviews_raw_quarantine", "bronze tables", "0", "silver", None,
         "no rows quarantined"),
        ("drug_reviews_clean_quarantine", "bronze tables", "0", "silver", None,
         "no rows quarantined"),
        ("dim_drugs", "bronze tables", "(SELECT COUNT(*) FROM dim_items)", "silver", None,
         "dimension with SCD2 tracking"),
        ("dim_drugs_history", "dim_drugs", "0", "silver", None, "closed versions"),
        ("dim_conditions", "bronze tables", "(SELECT COUNT(*) FROM dim_groups)", "silver", None,
         "dimension table"),
        ("fact_drug_performance", "bronze tables", "(SELECT COUNT(*) FROM fact)", "silver",
         fact_status, fact_note),
        ("fact_drug_performance_orphans", "bronze tables", "0", "silver", None,
         "every fact has its dimension rows"),
        ("drug_effectiveness_ranking", "silver tables",
         "(SELECT COUNT(*) FROM (SELECT DISTINCT condition_name, drug_name, drug_type, "
         "drug_form FROM star))", "gold", None, "rankings by group"),
        ("price_performance_analysis", "silver tables", value_groups, "gold", None,
         "price vs performance"),
        ("condition_treatment_summary", "silver tables",
         "(SELECT COUNT(DISTINCT condition_name) FROM star)", "gold", None,
         "group treatment options"),
    ]
    body = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{src}' AS source_file, CAST({n} AS BIGINT) AS record_count,"
        f" {ts} AS load_timestamp, '{layer}' AS layer, {status or lit('success')} AS status,"
        f" {note if status else lit(note)} AS notes"
        for t, src, n, layer, status, note in rows)
    return f"""{w},
star AS (SELECT g.condition_name, d.drug_name, d.drug_type, d.drug_form,
                d.average_price AS drug_avg_price, f.price
         FROM fact f JOIN dim_items d ON f.drug_key = d.drug_key
         JOIN dim_groups g ON f.condition_key = g.condition_key),
dup AS (SELECT performance_key, COUNT(*) AS n FROM fact GROUP BY performance_key
        HAVING COUNT(*) > 1)
{body}"""


def _silver_ranking_sql(w: str, extra: str = "") -> str:
    score = (f"COALESCE(effectiveness_score, 0) * CAST(0.4 AS DOUBLE)"
             f" + COALESCE(satisfaction_score, 0) * CAST(0.4 AS DOUBLE)"
             f" + COALESCE(ease_of_use_score, 0) * CAST(0.2 AS DOUBLE)")
    return f"""{w},
star AS (SELECT g.condition_name, d.drug_name, d.drug_type, d.drug_form,
                d.average_price AS drug_avg_price, f.effectiveness_score, f.ease_of_use_score,
                f.satisfaction_score, f.review_count, f.price
         FROM fact f JOIN dim_items d ON f.drug_key = d.drug_key
         JOIN dim_groups g ON f.condition_key = g.condition_key),
agg AS (SELECT condition_name, drug_name, drug_type, drug_form,
               {_avg('effectiveness_score')} AS effectiveness_score,
               {_avg('ease_of_use_score')} AS ease_of_use_score,
               {_avg('satisfaction_score')} AS satisfaction_score,
               CAST(SUM(COALESCE(review_count, 0)) AS BIGINT) AS total_reviews,
               {_avg(_PRICE)} AS average_price
        FROM star GROUP BY condition_name, drug_name, drug_type, drug_form),
scored AS (SELECT *, {_r(score, 2)} AS overall_score FROM agg)
SELECT condition_name, drug_name, drug_type, drug_form, effectiveness_score,
       ease_of_use_score, satisfaction_score, overall_score,
       CAST(DENSE_RANK() OVER (PARTITION BY condition_name
            ORDER BY overall_score DESC NULLS LAST) AS INTEGER) AS overall_rank,
       total_reviews, average_price{extra}
FROM scored"""


def _event_sqls() -> dict[str, str]:
    rules = analogs.EVENT_RULES_SQL
    failed = {n: f"NOT COALESCE({p}, FALSE)" for n, p in rules.items()}
    names = ", ".join(f"CASE WHEN {f} THEN '{n}' END" for n, f in failed.items())
    any_failed = " OR ".join(failed.values())
    per_rule = ",\n       ".join(f"COUNT(*) FILTER (WHERE {f}) AS failed_{n}"
                                 for n, f in failed.items())
    cut, (run1, run2) = analogs.FIRST_SEEN_CUTOFF, analogs.FIRST_SEEN_RUNS
    act = """SELECT user_id, event_type, COUNT(*) AS events,
                    CASE WHEN COUNT(value) > 0 THEN """ + analogs.total_sql("value") + """ END AS total_value
             FROM events {w} GROUP BY user_id, event_type"""
    cols = ", ".join(f"CAST(c_{c} AS VARCHAR)" for c in
                     ("custkey", "name", "nationkey", "acctbal", "mktsegment"))
    return {
        "quality_split": f"""
SELECT *, CASE WHEN {any_failed} THEN 'quarantine' ELSE 'valid' END AS side,
       concat_ws(',', {names}) AS failed_rules
FROM events""",
        "rule_counts": f"""
SELECT COUNT(*) AS rows,
       {per_rule},
       COUNT(*) FILTER (WHERE {any_failed}) AS quarantined_rows,
       COUNT(*) FILTER (WHERE NOT ({any_failed})) AS valid_rows
FROM events""",
        "first_seen": f"""
WITH l1 AS ({act.format(w=f"WHERE ts < TIMESTAMP '{cut}'")}),
l2 AS ({act.format(w="")})
SELECT l2.*, LEAST(COALESCE(l1x.first_seen_date, TIMESTAMP '{run2}'), TIMESTAMP '{run2}')
             AS first_seen_date,
       TIMESTAMP '{run2}' AS last_updated_date
FROM l2 LEFT JOIN (SELECT user_id, event_type, TIMESTAMP '{run1}' AS first_seen_date FROM l1) l1x
  ON l2.user_id = l1x.user_id AND l2.event_type = l1x.event_type""",
        "record_ids": f"""
SELECT *, TIMESTAMP '{analogs.FEED_RUN_TS}' AS ingestion_timestamp,
       'customer' AS source_file,
       md5(concat_ws('||', {cols})) AS record_id,
       md5(to_json([{cols}])) AS row_hash
FROM customer""",
    }


# --- Spark queries ----------------------------------------------------------------

def q_ranking_mart(spark: SparkSession, d: str) -> DataFrame:
    return marts.ranking(analogs.review_star(spark, d), analogs.analog_mart_spec())


def q_value_mart(spark: SparkSession, d: str) -> DataFrame:
    return marts.value(analogs.review_star(spark, d), analogs.analog_mart_spec())


def q_summary_mart(spark: SparkSession, d: str) -> DataFrame:
    return marts.summary(analogs.review_star(spark, d), analogs.analog_mart_spec())


def q_best_in_group(spark: SparkSession, d: str) -> DataFrame:
    return marts.best_in_group(q_ranking_mart(spark, d), n=5)


def q_best_value_in_tier(spark: SparkSession, d: str) -> DataFrame:
    return marts.best_value_in_tier(q_value_mart(spark, d), n=10)


def q_group_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    return marts.group_leaderboard(q_summary_mart(spark, d), position="position")


_LINE_ORDER = "l_quantity DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey"


def q_global_position(spark: SparkSession, d: str) -> DataFrame:
    """Position of every line item in an order of 50 values, ties by order and line."""
    from pyspark.sql import functions as F
    from strata.operators.rank import global_position
    li = analogs.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return global_position(li, [F.col("l_quantity").desc_nulls_last(), "l_orderkey", "l_linenumber", "l_partkey"])


def q_exact_average(spark: SparkSession, d: str) -> DataFrame:
    """Averages of a measure with all the digits of a double, whatever the order of rows."""
    from pyspark.sql import functions as F
    from strata.functions.scoring import exact_avg, exact_total
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return (analogs.table(spark, d, "lineitem").groupBy("l_partkey")
            .agg(exact_avg(unit).alias("avg_unit_price"), exact_total(-unit / 3).alias("third"),
                 F.count(unit).alias("n")))


def q_group_lookup(spark: SparkSession, d: str) -> DataFrame:
    """One group's items in order of rank, as a user looks them up; the position shows the order."""
    found = marts.best_in_group(q_ranking_mart(spark, d), n=10, groups=["BUILDING"], position="position")
    return found.select("position", "drug_name", "overall_rank", "overall_score", "total_reviews")


def q_tier_lookup(spark: SparkSession, d: str) -> DataFrame:
    """One price tier's ten best values in order."""
    found = marts.best_value_in_tier(q_value_mart(spark, d), n=10, tiers=["Low"])
    return found.select("value_rank", "drug_name", "drug_type", "value_score")


def _item_history(spark: SparkSession, d: str) -> DataFrame:
    """Three loads that together read all line items: first load, then two merges. Each load's result is
    written under the checkpoint folder, as a pipeline writes its table, so the
    next load reads it once."""
    from strata.session import materialize
    y0, y1, y2 = analogs.LOADS
    # snapshots are aggregates by the business key: unique by construction, so
    # the duplicate-key validation job is skipped
    h = scd2.apply(None, analogs.item_snapshot(spark, d, y0), _SCD_SPEC, analogs.load_date(y0),
                   validate=False)
    for y in (y1, y2):
        h = scd2.merge(materialize(h, "scd2_history"), analogs.item_snapshot(spark, d, y),
                       _SCD_SPEC, analogs.load_date(y), validate=False)
    return h


def q_scd2_initial(spark: SparkSession, d: str) -> DataFrame:
    """First load of a snapshot of all line items."""
    span = analogs.EVERYTHING
    return scd2.apply(None, analogs.item_snapshot(spark, d, span), _SCD_SPEC, analogs.load_date(span),
                      validate=False)


def q_scd2_merge(spark: SparkSession, d: str) -> DataFrame:
    return _item_history(spark, d)


def q_scd2_versions(spark: SparkSession, d: str) -> DataFrame:
    return scd2.versions(_item_history(spark, d), _SCD_SPEC, min_versions=2)


def q_scd2_health(spark: SparkSession, d: str) -> DataFrame:
    return scd2.health(_item_history(spark, d), _SCD_SPEC)


def q_scd2_as_of(spark: SparkSession, d: str) -> DataFrame:
    from datetime import date
    return scd2.as_of_view(_item_history(spark, d), _SCD_SPEC, date.fromisoformat(_AS_OF_PROBE))


def q_scd2_closed(spark: SparkSession, d: str) -> DataFrame:
    return scd2.closed_versions(_item_history(spark, d), _SCD_SPEC)


def q_scd2_off(spark: SparkSession, d: str) -> DataFrame:
    """SCD2 disabled in the configuration, over a table an earlier load wrote: a plain replace."""
    from strata.config import PipelineConfig, default_config_dict
    from strata.session import scratch_path
    from strata.sources import tables
    root = scratch_path(spark, "scd2-off")
    db = "strata_off_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}.db'")
    options = default_config_dict(root)
    options["scd2"] = {**options.get("scd2", {}), "enabled": False}
    cfg = PipelineConfig.from_dict(options)
    spec = cfg.scd2_spec("dim_drugs")
    name = f"{db}.dim_items"
    for span in (analogs.LOADS[0], analogs.EVERYTHING):
        known = spark.table(name) if tables.exists(spark, name) else None
        load = scd2.apply(known, analogs.item_snapshot(spark, d, span), spec or _SCD_SPEC,
                          analogs.load_date(span), enabled=spec is not None, validate=False)
        tables.replace_table(load, name)
    return spark.table(name)


def _silver_inputs(spark: SparkSession, d: str):
    """The two bronze feeds (cut from one written extract, as the pipeline's
    bronze tables are written once) with lineage, cleansed."""
    raw, clean = analogs.silver_feeds(spark, d)
    raw = with_lineage(raw, analogs.FEED_RUN_TS, source_file="raw_feed")
    clean = with_lineage(clean, analogs.FEED_RUN_TS, source_file="clean_feed")
    return star.cleanse_raw(raw), star.cleanse_clean(clean)


def q_cleanse_raw(spark: SparkSession, d: str) -> DataFrame:
    raw_c, _ = _silver_inputs(spark, d)
    return raw_c.select(*_CLEANSED, "effective_clean", "ease_of_use_clean", "satisfaction_clean")


def q_cleanse_clean(spark: SparkSession, d: str) -> DataFrame:
    _, clean_c = _silver_inputs(spark, d)
    return clean_c.select(*_CLEANSED)


def q_dim_two_feeds(spark: SparkSession, d: str) -> DataFrame:
    return star.item_dimension(*_silver_inputs(spark, d))


def q_dim_keyword(spark: SparkSession, d: str) -> DataFrame:
    raw_c, clean_c = _silver_inputs(spark, d)
    return star.group_dimension(raw_c, clean_c, analogs.FEED_RUN_TS, rules=analogs.NAME_RULES)


def q_fact_two_feeds(spark: SparkSession, d: str) -> DataFrame:
    return star.fact(*_silver_inputs(spark, d))


def q_silver_ranking_mart(spark: SparkSession, d: str) -> DataFrame:
    """Gold ranking over the silver star: the fact aggregated by its keys, then the dimensions.

    Each cleansed feed is written once, as the pipeline does; dimensions and fact read that."""
    from strata.session import materialize
    raw_c, clean_c = (materialize(cleanse(with_lineage(feed(spark, d), analogs.FEED_RUN_TS, source_file=name)), name)
                      for cleanse, feed, name in ((star.cleanse_raw, analogs.raw_feed, "raw_feed"),
                                                  (star.cleanse_clean, analogs.clean_feed, "clean_feed")))
    items = star.item_dimension(raw_c, clean_c)
    groups = star.group_dimension(raw_c, clean_c, analogs.FEED_RUN_TS, rules=analogs.NAME_RULES)
    r = marts.ranking(marts.base_of_fact(star.fact(raw_c, clean_c), items, groups), from_base=True)
    return r.drop("effectiveness_rank", "satisfaction_rank")


def q_quality_split(spark: SparkSession, d: str) -> DataFrame:
    """Valid rows and quarantined rows side by side (they partition the input)."""
    from pyspark.sql import functions as F
    valid, bad = quality.split(analogs.table(spark, d, "events"), analogs.event_rules())
    return (valid.withColumn("side", F.lit("valid")).withColumn("failed_rules", F.lit(""))
            .unionByName(bad.withColumn("side", F.lit("quarantine"))
                         .withColumn("failed_rules", F.concat_ws(",", "failed_rules"))))


def q_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.counts(analogs.table(spark, d, "events"), analogs.event_rules())


def q_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of a (user, event type) dimension; load 2 keeps load 1's first-seen time."""
    from pyspark.sql import functions as F
    ev = analogs.table(spark, d, "events")
    run1, run2 = analogs.FIRST_SEEN_RUNS
    cut = F.lit(analogs.FIRST_SEEN_CUTOFF).cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    load1 = star.carry_first_seen(analogs.event_activity(ev.filter(F.col("ts") < cut)), None,
                                  keys, run1)
    return star.carry_first_seen(analogs.event_activity(ev), load1, keys, run2)


def q_record_ids(spark: SparkSession, d: str) -> DataFrame:
    """Lineage columns on a table: run time, source, content hash (both styles)."""
    from strata.functions.keys import record_id
    cust = analogs.table(spark, d, "customer")
    src = list(cust.columns)
    return (with_lineage(cust, analogs.FEED_RUN_TS, source_file="customer")
            .withColumn("row_hash", record_id(src, style="unambiguous")))


_PIPELINE_RUNS: dict = {}


def _pipeline(spark: SparkSession, d: str):
    """Run the whole pipeline once per session and input folder.

    The feeds are written as CSV, and every table lives, under a fresh folder
    of the session's checkpoint folder (shared storage on a cluster).
    """
    from datetime import date, datetime

    from strata.config import PipelineConfig, default_config_dict
    from strata.plans import pipeline
    from strata.session import scratch_path

    key = (spark.sparkContext.applicationId, d)
    if key not in _PIPELINE_RUNS:
        root = scratch_path(spark, "pipeline")
        analogs.write_feed_csvs(spark, d, f"{root}/volume")
        prefix = f"strata_{abs(hash(root)) % 10**8}_"
        cfg = PipelineConfig.from_dict(default_config_dict(f"{root}/volume"), prefix=prefix)
        run_ts = datetime.fromisoformat(analogs.FEED_RUN_TS)
        pipeline.run_pipeline(spark, cfg, run_ts, date(2024, 2, 1), location_root=root)
        _PIPELINE_RUNS[key] = cfg
    return _PIPELINE_RUNS[key]


def q_pipeline_run(spark: SparkSession, d: str) -> DataFrame:
    """Bronze -> silver -> gold from CSV files; the gold ranking table as written."""
    cfg = _pipeline(spark, d)
    return spark.table(cfg.table("gold", "drug_effectiveness_ranking"))


def q_audit_rows(spark: SparkSession, d: str) -> DataFrame:
    """The audit log of the run: one row per written table with its row count."""
    cfg = _pipeline(spark, d)
    return spark.table(cfg.table("landing", "metadata_tracking"))


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The bronze raw table: CSV read under its contract, plus lineage."""
    cfg = _pipeline(spark, d)
    return spark.table(cfg.table("bronze", "drug_reviews_raw")).drop("source_file")


def q_audit_latest(spark: SparkSession, d: str) -> DataFrame:
    """Run monitoring: the audit log newest first."""
    from strata.sources.tables import latest_runs
    return latest_runs(q_audit_rows(spark, d), position="position")


def q_dirty_feed_audit(spark: SparkSession, d: str) -> DataFrame:
    """Two daily loads of feeds with faults, quarantine off: what the audit log says of the bad rows,
    and what became of them in silver."""
    from datetime import date, datetime

    from pyspark.sql import functions as F

    from strata.config import PipelineConfig, default_config_dict
    from strata.plans import pipeline
    from strata.session import scratch_path
    root = scratch_path(spark, "dirty")
    analogs.write_feed_csvs(spark, d, f"{root}/volume", dirty=True)
    options = default_config_dict(f"{root}/volume")
    options["pipeline"]["enable_quarantine"] = False
    cfg = PipelineConfig.from_dict(options, prefix=f"strata_dirty_{root.rsplit('-', 1)[1]}_")
    for day in (1, 2):
        pipeline.run_pipeline(spark, cfg, datetime(2024, 2, day), date(2024, 2, day), location_root=root)
    audit = (spark.table(cfg.table("landing", "metadata_tracking"))
             .filter("layer = 'bronze' OR table_name IN ('drug_reviews_raw', 'drug_reviews_clean')")
             .select("layer", "table_name", F.dayofmonth("load_timestamp").alias("day"), "record_count", "status",
                     "notes"))
    fact = spark.table(cfg.table("silver", "fact_drug_performance")).agg(
        F.count("*").alias("record_count"),
        F.concat(F.lit("no item: "), F.count_if(F.col("drug_key").isNull()), F.lit(", no group: "),
                 F.count_if(F.col("condition_key").isNull()), F.lit(", NaN: "),
                 F.count_if(F.isnan("effectiveness_score")), F.lit(", reviews: "),
                 F.sum(F.when(F.col("data_source") == "clean", F.col("review_count")))).alias("notes"))
    kept = fact.select(F.lit("silver").alias("layer"), F.lit("fact").alias("table_name"), F.lit(2).alias("day"),
                       "record_count", F.lit("rows").alias("status"), "notes")
    first = (spark.table(cfg.table("silver", "dim_conditions")).filter("condition_key IS NOT NULL")
             .agg(F.count("*").alias("record_count"), F.concat(
                 F.lit("first seen on day "), F.min(F.dayofmonth("first_seen_date")), F.lit(" to "),
                 F.max(F.dayofmonth("first_seen_date"))).alias("notes"))
             .select(F.lit("silver").alias("layer"), F.lit("groups").alias("table_name"), F.lit(2).alias("day"),
                     "record_count", F.lit("rows").alias("status"), "notes"))
    # labels of raw rows, some of which hold a line break
    labels = (spark.table(cfg.table("silver", "fact_drug_performance")).filter("data_source = 'raw'")
              .groupBy(F.concat(F.lit("label "), "drug_type").alias("table_name")).agg(F.count("*").alias("record_count"))
              .select(F.lit("silver").alias("layer"), "table_name", F.lit(2).alias("day"), "record_count",
                      F.lit("rows").alias("status"), F.lit("").alias("notes")))
    return audit.unionByName(kept).unionByName(first).unionByName(labels)


def _dirty_feed_sql() -> str:
    def audit(layer: str, table: str, count: str, bad: str, good: str) -> str:
        return f"""
SELECT '{layer}' AS layer, '{table}' AS table_name, day, CAST(({count}) AS BIGINT) AS record_count,
       CASE WHEN ({bad}) IS NULL THEN 'success' ELSE 'warning' END AS status, COALESCE(({bad}), '{good}') AS notes
FROM days"""

    def counted(name: str, n: str) -> str:
        return f"concat(chr(39), '{name}', chr(39), ': ', {n})"

    def rule(table: str) -> str:
        n_item = f"(SELECT COUNT(*) FILTER (WHERE drug IS NULL) FROM {table})"
        n_group = f"(SELECT COUNT(*) FILTER (WHERE condition IS NULL) FROM {table})"
        named = (f"CASE WHEN {n_item} > 0 THEN {counted('failed_item_present', n_item)} END, "
                 f"CASE WHEN {n_group} > 0 THEN {counted('failed_group_present', n_group)} END")
        return (f"SELECT CASE WHEN {n_item} + {n_group} > 0 THEN concat('rows failing rules, kept: {{', "
                f"concat_ws(', ', {named}), '}}') END")

    cast = (f"SELECT CASE WHEN COUNT(*) > 0 THEN concat('values that do not fit their type: {{', "
            f"{counted('price', 'COUNT(*)')}, '}}') END FROM clean WHERE price = 'abc'")
    return f"""
WITH days AS (SELECT unnest([1, 2]) AS day),
raw AS (SELECT * REPLACE (CASE WHEN ease_of_use = '0.03' THEN NULL ELSE drug END AS drug,
          CASE WHEN ease_of_use = '0.07' THEN 'NaN' ELSE effective END AS effective) FROM ({analogs.RAW_FEED_SQL})),
clean AS (SELECT * REPLACE (CASE WHEN ease_of_use = 0.03 THEN 'abc' ELSE CAST(price AS VARCHAR) END AS price,
          CASE WHEN satisfaction = 0.07 THEN NULL ELSE condition END AS condition) FROM ({analogs.CLEAN_FEED_SQL}))
{audit('bronze', 'drug_reviews_raw', 'SELECT COUNT(*) FROM raw', 'SELECT NULL', 'loaded')}
UNION ALL {audit('bronze', 'drug_reviews_clean', 'SELECT COUNT(*) FROM clean', cast, 'loaded')}
UNION ALL {audit('silver', 'drug_reviews_raw', 'SELECT COUNT(*) FROM raw', rule('raw'), 'no row fails a rule')}
UNION ALL {audit('silver', 'drug_reviews_clean', 'SELECT COUNT(*) FROM clean', rule('clean'), 'no row fails a rule')}
UNION ALL
SELECT 'silver', 'fact', 2, (SELECT COUNT(*) FROM raw) + (SELECT COUNT(*) FROM clean), 'rows',
  concat('no item: ', (SELECT COUNT(*) FROM raw WHERE drug IS NULL), ', no group: ',
         (SELECT COUNT(*) FROM clean WHERE condition IS NULL), ', NaN: ',
         (SELECT COUNT(*) FROM raw WHERE effective = 'NaN'), ', reviews: ', (SELECT CAST(SUM(reviews) AS BIGINT) FROM clean))
UNION ALL
SELECT 'silver', 'groups', 2, COUNT(DISTINCT g), 'rows', 'first seen on day 1 to 1' FROM (
  SELECT {_initcap('condition')} AS g FROM raw WHERE condition IS NOT NULL
  UNION ALL SELECT {_initcap('condition')} FROM clean WHERE condition IS NOT NULL)
UNION ALL SELECT 'silver', concat('label ', {_label('type')}), 2, COUNT(*), 'rows', '' FROM ({analogs.RAW_FEED_SQL}) GROUP BY 2"""


def q_bronze_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The raw feed's CSV files ingested by the file-stream job (new files only, once)."""
    from datetime import datetime

    from strata.session import scratch_path
    from strata.sources.contracts import contract
    from strata.streaming import ingest_new_files
    root = scratch_path(spark, "stream")
    analogs.write_feed_csvs(spark, d, f"{root}/volume")
    ingest_new_files(spark, f"{root}/volume/Drug.csv", contract("drug_reviews_raw"),
                     f"{root}/bronze_raw", datetime.fromisoformat(analogs.FEED_RUN_TS),
                     checkpoint=f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/bronze_raw").drop("source_file")


def q_contract_conform(spark: SparkSession, d: str) -> DataFrame:
    """A table conformed to a contract: casts, a failing cast, a missing and an extra column."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    from strata.sources.contracts import conform
    schema = StructType.fromDDL(
        "o_orderkey BIGINT, o_custkey INT, o_orderstatus INT, o_totalprice DOUBLE, "
        "o_orderdate DATE, o_orderpriority STRING, o_comment STRING")
    df, _ = conform(analogs.table(spark, d, "orders"), schema, errors_col="cast_errors")
    return df.withColumn("cast_errors", F.concat_ws(",", "cast_errors"))


# --- rows that do not get through, runs that stop, histories and facts in time --------------

def q_fact_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Line items that a star join would drop, with the reasons: parts and suppliers are missing, some keys are null."""
    from pyspark.sql import functions as F
    from strata.operators.references import REASONS, Reference, find_orphans
    fact = analogs.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") != 13, F.col("l_partkey")).alias("item_key"),
        F.col("l_suppkey").alias("supplier_key"))
    items = analogs.table(spark, d, "part").filter("p_size % 7 <> 0").select("p_partkey")
    suppliers = analogs.table(spark, d, "supplier").filter("s_acctbal >= 0").select("s_suppkey")
    found = find_orphans(fact, [Reference("item_key", items, "p_partkey", "items"),
                                Reference("supplier_key", suppliers, "s_suppkey", "suppliers")])
    return found.filter(F.size(REASONS) > 0).withColumn(REASONS, F.array_join(REASONS, ", "))


def q_unreadable_rows(spark: SparkSession, d: str) -> DataFrame:
    """A feed with broken lines: the records that cannot be read, with their text, and what is read of the others."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from strata.session import scratch_path
    from strata.sources import csv
    from strata.sources.contracts import contract
    root = scratch_path(spark, "broken")
    analogs.write_broken_feed(spark, d, f"{root}/Broken.csv")
    df, _ = csv.ingest(spark, f"{root}/Broken.csv", contract("drug_reviews_raw"),
                       datetime.fromisoformat(analogs.FEED_RUN_TS), multiline=False, unreadable_col="unreadable")
    folder = F.regexp_extract("source_file", "/([^/]+)/[^/]+$", 1).alias("feed")
    bad = df.filter("unreadable IS NOT NULL").select(folder, F.lit("unreadable").alias("state"), F.col("unreadable").alias("record"))
    good = df.filter("unreadable IS NULL").select(folder, F.lit("read").alias("state"), F.concat_ws("|", *(
        F.coalesce(c, F.lit("")) for c in ("condition", "drug", "indication", "type", "reviews", "effective", "ease_of_use",
                                           "satisfaction", "information"))).alias("record"))
    return bad.unionByName(good)


def q_scd2_any_order(spark: SparkSession, d: str) -> DataFrame:
    """The three loads applied out of order, the first one last: the history is the same."""
    from strata.operators import scd2_timeline
    from strata.session import materialize
    y0, y1, y2 = analogs.LOADS
    h = None
    for y in (y1, y2, y0):
        h = materialize(scd2_timeline.merge_at(h, analogs.item_snapshot(spark, d, y), _SCD_SPEC, analogs.load_date(y),
                                               validate=False), "scd2_timeline")
    return h.drop(scd2_timeline.OBSERVED)


def q_scd2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The three loads into a partitioned history, each touching only what it changes."""
    import uuid

    from strata.operators import scd2_store
    from strata.session import _scratch_db
    table = f"{_scratch_db(spark)}.items_{uuid.uuid4().hex[:12]}"
    for y in analogs.LOADS:
        scd2_store.load(analogs.item_snapshot(spark, d, y), table, _SCD_SPEC, analogs.load_date(y), validate=False)
    return scd2_store.history(spark, table, _SCD_SPEC)


def q_star_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Every line item with the item version valid when it shipped."""
    from pyspark.sql import functions as F

    from strata.operators.asof import star_at
    fact = analogs.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item_key"),
                                                      "l_shipdate")
    return star_at(fact, _item_history(spark, d), _SCD_SPEC, "l_shipdate", ["item_type", "average_price"])


def q_version_lookup(spark: SparkSession, d: str) -> DataFrame:
    """One item's versions, newest first."""
    return scd2.versions(_item_history(spark, d), _SCD_SPEC, keys=[1])


def q_dim_unmatched_feeds(spark: SparkSession, d: str) -> DataFrame:
    """The item dimension of two feeds that each lack some of the other's items."""
    raw_c, clean_c = _silver_inputs(spark, d)
    return star.item_dimension(raw_c.filter("drug_clean NOT LIKE '%1'"), clean_c.filter("drug_clean NOT LIKE '%2'"))


def q_resumed_run(spark: SparkSession, d: str) -> DataFrame:
    """A run that is stopped between silver and gold and run again: its audit log in order, and the ledger's stages."""
    from datetime import date, datetime

    from pyspark.sql import functions as F

    from strata.config import PipelineConfig, default_config_dict
    from strata.plans import pipeline
    from strata.session import scratch_path
    from strata.sources.tables import latest_runs
    root = scratch_path(spark, "resumed")
    analogs.write_feed_csvs(spark, d, f"{root}/volume")
    cfg = PipelineConfig.from_dict(default_config_dict(f"{root}/volume"), prefix=f"strata_resumed_{root.rsplit('-', 1)[1]}_")
    run_ts = datetime.fromisoformat(analogs.FEED_RUN_TS)

    def stop(layer: str) -> None:
        if layer == "gold":
            raise RuntimeError("stopped before gold")
    try:
        pipeline.run_pipeline(spark, cfg, run_ts, date(2024, 2, 1), location_root=root, before=stop)
    except RuntimeError:
        pass
    for _ in range(2):                       # the second time everything has finished
        pipeline.run_pipeline(spark, cfg, run_ts, date(2024, 2, 1), location_root=root)
    audit = latest_runs(spark.table(cfg.table("landing", "metadata_tracking")), position="position")
    stages = (pipeline.run_ledger(spark, cfg).rows().groupBy("stage", "state").count()
              .select(F.col("stage").alias("table_name"), F.lit("ledger").alias("layer"), F.col("state").alias("status"),
                      F.col("count").alias("record_count"), F.lit("").alias("notes"), F.lit(0).cast("long").alias("position")))
    return audit.select("table_name", "layer", "status", "record_count", "notes", "position").unionByName(stages)


def q_average_extremes(spark: SparkSession, d: str) -> DataFrame:
    """Averages of very small, very large and mixed values, scaled back to ten digits."""
    from pyspark.sql import functions as F

    from strata.functions.scoring import exact_avg
    x = F.col("l_extendedprice")
    big = F.when(F.col("l_linenumber") == 1, x * 1e13).otherwise(x * 1e-13)
    return analogs.table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.round(exact_avg(x * 1e-25) * 1e25, 4).alias("tiny"), F.round(exact_avg(x * 1e13) / 1e13, 4).alias("wide"),
        F.round(exact_avg(big) / 1e13, 4).alias("mixed"), F.round(exact_avg(x * 1e200) / 1e200, 4).alias("huge"))


def q_marts_by_difference(spark: SparkSession, d: str) -> DataFrame:
    """The ranking mart after two loads, the second of which computes only the groups it touches."""
    from strata.plans import mart_state
    from strata.session import materialize, scratch_path
    raw_c, clean_c = _silver_inputs(spark, d)
    items = materialize(star.item_dimension(raw_c, clean_c), "items")
    groups = materialize(star.group_dimension(raw_c, clean_c, analogs.FEED_RUN_TS, rules=analogs.NAME_RULES), "groups")
    facts = star.fact(raw_c, clean_c)
    root = scratch_path(spark, "mart-state")
    for load in ("raw", "clean"):
        touched = mart_state.put_load(facts.filter(facts.data_source == load), f"{root}/state", load)
        mart = mart_state.refresh(spark, f"{root}/state", f"{root}/ranking", items, groups, touched, marts.ranking)
    return mart.drop("effectiveness_rank", "satisfaction_rank")


def q_rule_table(spark: SparkSession, d: str) -> DataFrame:
    """Every part with the category of its name, by rules that are rows of a table."""
    from strata.operators.rule_table import categorise_by_table, rules_frame
    parts = analogs.table(spark, d, "part").select("p_partkey", "p_name")
    return categorise_by_table(parts, "p_name", rules_frame(spark, analogs.NAME_RULES))


def q_stream_checked(spark: SparkSession, d: str) -> DataFrame:
    """The raw feed with faults, taken in by the stream with checks: valid and quarantined rows by rule, and what the audit says."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from strata.session import scratch_path
    from strata.sources.contracts import contract
    from strata.streaming import checked
    root = scratch_path(spark, "checked")
    analogs.write_feed_csvs(spark, d, f"{root}/volume", dirty=True)
    rules = {"item_present": F.col("drug").isNotNull(), "score_is_number": F.col("effective") != "NaN"}
    audit = checked.ingest_checked(spark, f"{root}/volume/Drug.csv", contract("drug_reviews_raw"), rules, f"{root}/target",
                                   f"{root}/quarantine", f"{root}/audit", datetime.fromisoformat(analogs.FEED_RUN_TS),
                                   f"{root}/checkpoint", max_files_per_batch=2)
    by_rule = (spark.read.parquet(f"{root}/quarantine").groupBy(F.array_join("failed_rules", ",").alias("part"))
               .agg(F.count("*").alias("n")))
    told = audit.agg(*(F.sum(c).alias(c) for c in ("rows", "valid_rows", "quarantined_rows")),
                     *(F.sum(F.col("failures")[r]).alias(r) for r in rules))
    valid = spark.read.parquet(f"{root}/target").agg(F.lit("valid").alias("part"), F.count("*").alias("n"))
    return by_rule.unionByName(valid).unionByName(told.unpivot([], told.columns, "part", "n"))


def _time_sqls() -> dict[str, str]:
    h = _scd2_history_sql()
    fields = ["condition", "drug", "indication", "type", "reviews", "effective", "ease_of_use", "satisfaction", "information"]
    broken = f"""SELECT * REPLACE (
  CASE WHEN ease_of_use = '{analogs.EXTRA_FIELD}' THEN concat(information, ',x') ELSE information END AS information,
  CASE WHEN satisfaction = '{analogs.OPEN_QUOTE}' THEN concat('"', indication) ELSE indication END AS indication)
FROM ({analogs.RAW_FEED_SQL})"""
    bad = f"(ease_of_use = '{analogs.EXTRA_FIELD}' OR satisfaction = '{analogs.OPEN_QUOTE}')"

    def line(sep: str) -> str:
        return "concat_ws('" + sep + "', " + ", ".join(f"COALESCE({f}, '')" for f in fields) + ")"

    def avg(x: str, by: str) -> str:
        return f"ROUND(fsum({x}) / COUNT(*) {by}, 4)"
    x = "l_extendedprice"
    return {
        "fact_orphans": """
WITH f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <> 13 THEN l_partkey END AS item_key,
                  l_suppkey AS supplier_key FROM lineitem),
i AS (SELECT p_partkey FROM part WHERE p_size % 7 <> 0), s AS (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
SELECT * FROM (SELECT f.*, concat_ws(', ', CASE WHEN item_key IS NULL THEN 'item_key is null'
       WHEN NOT EXISTS (SELECT 1 FROM i WHERE p_partkey = item_key) THEN 'item_key not in items' END,
       CASE WHEN NOT EXISTS (SELECT 1 FROM s WHERE s_suppkey = supplier_key) THEN 'supplier_key not in suppliers' END) AS orphan_of
  FROM f) WHERE orphan_of <> ''""",
        "unreadable_rows": f"""
WITH b AS ({broken})
SELECT 'Broken.csv' AS feed, 'unreadable' AS state, {line(',')} AS record FROM b WHERE {bad}
UNION ALL SELECT 'Broken.csv', 'read', {line('|')} FROM b WHERE NOT {bad}""",
        "scd2_any_order": f"{h}\nSELECT * FROM h2",
        "scd2_incremental": f"{h}\nSELECT * FROM h2",
        "star_as_of": f"""{h}
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS item_key, l.l_shipdate, v.effective_date, v.end_date, v.item_type, v.average_price
FROM lineitem l ASOF LEFT JOIN h2 v ON l.l_partkey = v.item_key AND l.l_shipdate >= v.effective_date""",
        "version_lookup": f"""{h}
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY effective_date DESC) AS INTEGER) AS version_number, COUNT(*) OVER () AS version_count
FROM h2 WHERE item_key = 1""",
        "marts_by_difference": _silver_ranking_sql(f"WITH {_silver_ctes()}"),
        "rule_table": f"SELECT p_partkey, p_name, {_rules_case('p_name', analogs.NAME_RULES)} AS category FROM part",
        "stream_checked": f"""
WITH f AS (SELECT ease_of_use = '0.03' AS a, ease_of_use = '0.07' AS b FROM ({analogs.RAW_FEED_SQL}))
SELECT * FROM (SELECT CASE WHEN a THEN 'item_present' WHEN b THEN 'score_is_number' ELSE 'valid' END AS part, COUNT(*) AS n
  FROM f GROUP BY 1)
UNION ALL SELECT 'rows', COUNT(*) FROM f UNION ALL SELECT 'valid_rows', COUNT(*) FILTER (WHERE NOT a AND NOT b) FROM f
UNION ALL SELECT 'quarantined_rows', COUNT(*) FILTER (WHERE a OR b) FROM f
UNION ALL SELECT 'item_present', COUNT(*) FILTER (WHERE a) FROM f UNION ALL SELECT 'score_is_number', COUNT(*) FILTER (WHERE b) FROM f""",
        "average_extremes": f"""
SELECT l_suppkey, {avg(f'{x} * 1e-25::DOUBLE', '* 1e25::DOUBLE')} AS tiny, {avg(f'{x} * 1e13::DOUBLE', '/ 1e13::DOUBLE')} AS wide,
  {avg(f'CASE WHEN l_linenumber = 1 THEN {x} * 1e13::DOUBLE ELSE {x} * 1e-13::DOUBLE END', '/ 1e13::DOUBLE')} AS mixed,
  {avg(f'{x} * 1e200::DOUBLE', '/ 1e200::DOUBLE')} AS huge
FROM lineitem GROUP BY l_suppkey""",
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the ranking mart (star join, aggregate, weighted score, dense ranks)."""
    return q_ranking_mart(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ranking_mart": q_ranking_mart,
        "best_in_group": q_best_in_group,
        "value_mart": q_value_mart,
        "best_value_in_tier": q_best_value_in_tier,
        "summary_mart": q_summary_mart,
        "group_leaderboard": q_group_leaderboard,
        "scd2_initial": q_scd2_initial,
        "scd2_merge": q_scd2_merge,
        "scd2_versions": q_scd2_versions,
        "scd2_health": q_scd2_health,
        "scd2_as_of": q_scd2_as_of,
        "scd2_closed": q_scd2_closed,
        "scd2_off": q_scd2_off,
        "global_position": q_global_position,
        "exact_average": q_exact_average,
        "group_lookup": q_group_lookup,
        "tier_lookup": q_tier_lookup,
        "cleanse_raw": q_cleanse_raw,
        "cleanse_clean": q_cleanse_clean,
        "dim_two_feeds": q_dim_two_feeds,
        "dim_keyword": q_dim_keyword,
        "fact_two_feeds": q_fact_two_feeds,
        "silver_ranking_mart": q_silver_ranking_mart,
        "quality_split": q_quality_split,
        "rule_counts": q_rule_counts,
        "first_seen": q_first_seen,
        "record_ids": q_record_ids,
        "pipeline_run": q_pipeline_run,
        "audit_rows": q_audit_rows,
        "csv_roundtrip": q_csv_roundtrip,
        "contract_conform": q_contract_conform,
        "audit_latest": q_audit_latest,
        "bronze_incremental": q_bronze_incremental,
        "dirty_feed_audit": q_dirty_feed_audit,
        "fact_orphans": q_fact_orphans,
        "unreadable_rows": q_unreadable_rows,
        "scd2_any_order": q_scd2_any_order,
        "scd2_incremental": q_scd2_incremental,
        "star_as_of": q_star_as_of,
        "version_lookup": q_version_lookup,
        "dim_unmatched_feeds": q_dim_unmatched_feeds,
        "resumed_run": q_resumed_run,
        "average_extremes": q_average_extremes,
        "rule_table": q_rule_table,
        "marts_by_difference": q_marts_by_difference,
        "stream_checked": q_stream_checked,
        **({**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "ranking_mart": _ranking_sql(),
        "best_in_group": _best_in_group_sql(),
        "value_mart": _value_sql(),
        "best_value_in_tier": _best_value_in_tier_sql(),
        "summary_mart": _summary_sql(),
        "group_leaderboard": _leaderboard_sql(),
        **_scd2_sqls(),
        **_lookup_sqls(),
        "dirty_feed_audit": _dirty_feed_sql(),
        **_silver_sqls(),
        **_event_sqls(),
        **_time_sqls(),
        **(llm.ORACLE_SQL if llm else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if llm and corpus_pipeline.ORACLE_SQL else {}),
    }
