"""Table contracts (one StructType per table) and ``conform``.

A contract is applied on read (no schema inference pass over the data) and
checked before every write, so declared types are what lands in the table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.cleanse import names_where

# ---------------------------------------------------------------------------
# The table layouts of the original pipeline (DDL order).
_LINEAGE = "ingestion_timestamp TIMESTAMP_NTZ, source_file STRING, record_id STRING"
CONTRACTS_DDL = {
    "metadata_tracking": "table_name STRING, source_file STRING, record_count BIGINT, "
                         "load_timestamp TIMESTAMP_NTZ, layer STRING, status STRING, notes STRING",
    "drug_reviews_raw": "condition STRING, drug STRING, indication STRING, type STRING, "
                        "reviews STRING, effective STRING, ease_of_use STRING, "
                        "satisfaction STRING, information STRING, " + _LINEAGE,
    "drug_reviews_clean": "condition STRING, drug STRING, ease_of_use DOUBLE, effective DOUBLE, "
                          "form STRING, indication STRING, price DOUBLE, reviews DOUBLE, "
                          "satisfaction DOUBLE, type STRING, " + _LINEAGE,
    "dim_drugs": "drug_key STRING, drug_name STRING, drug_type STRING, drug_form STRING, "
                 "average_price DOUBLE, drug_information STRING, effective_date DATE, "
                 "end_date DATE, is_current BOOLEAN",
    "dim_conditions": "condition_key STRING, condition_name STRING, condition_category STRING, "
                      "indication_type STRING, total_drugs_available BIGINT, "
                      "total_reviews_count BIGINT, first_seen_date TIMESTAMP_NTZ, "
                      "last_updated_date TIMESTAMP_NTZ",
    "fact_drug_performance": "drug_key STRING, condition_key STRING, effectiveness_score DOUBLE, "
                             "ease_of_use_score DOUBLE, satisfaction_score DOUBLE, "
                             "review_count INT, drug_form STRING, drug_type STRING, "
                             "price DOUBLE, data_source STRING, load_timestamp TIMESTAMP_NTZ, "
                             "performance_key STRING",
    "drug_effectiveness_ranking": "condition_name STRING, drug_name STRING, drug_type STRING, "
                                  "drug_form STRING, effectiveness_score DOUBLE, "
                                  "ease_of_use_score DOUBLE, satisfaction_score DOUBLE, "
                                  "overall_score DOUBLE, effectiveness_rank INT, "
                                  "satisfaction_rank INT, overall_rank INT, total_reviews BIGINT, "
                                  "average_price DOUBLE, last_updated TIMESTAMP_NTZ",
    "price_performance_analysis": "drug_name STRING, drug_type STRING, price_tier STRING, "
                                  "average_price DOUBLE, avg_effectiveness DOUBLE, "
                                  "avg_ease_of_use DOUBLE, avg_satisfaction DOUBLE, "
                                  "value_score DOUBLE, price_percentile INT, "
                                  "performance_percentile INT, total_reviews BIGINT, "
                                  "conditions_treated BIGINT, last_updated TIMESTAMP_NTZ",
    "condition_treatment_summary": "condition_name STRING, condition_category STRING, "
                                   "total_drugs_available BIGINT, rx_drugs_count BIGINT, "
                                   "otc_drugs_count BIGINT, tablet_options BIGINT, "
                                   "liquid_options BIGINT, topical_options BIGINT, "
                                   "injectable_options BIGINT, avg_effectiveness DOUBLE, "
                                   "avg_satisfaction DOUBLE, best_drug_by_effectiveness STRING, "
                                   "min_price DOUBLE, max_price DOUBLE, avg_price DOUBLE, "
                                   "total_patient_reviews BIGINT, last_updated TIMESTAMP_NTZ",
}
# ---------------------------------------------------------------------------


def contract(name: str) -> StructType:
    return StructType.fromDDL(CONTRACTS_DDL[name])


def source_part(c: StructType, lineage: tuple[str, ...] = ("ingestion_timestamp", "source_file",
                                                            "record_id")) -> StructType:
    """The contract without the lineage columns (what a source file carries)."""
    return StructType([f for f in c.fields if f.name not in lineage])


@dataclass
class ConformReport:
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    cast: list[str] = field(default_factory=list)

    @property
    def schema_changed(self) -> bool:
        return bool(self.missing or self.extra)

    def notes(self) -> str:
        parts = []
        if self.missing:
            parts.append(f"missing columns filled with null: {self.missing}")
        if self.extra:
            parts.append(f"extra columns dropped: {self.extra}")
        return "; ".join(parts)


def conform(df: DataFrame, schema: StructType, errors_col: str | None = None,
            keep_extra: bool = False) -> tuple[DataFrame, ConformReport]:
    """Order, cast and complete ``df`` to ``schema``.

    Casts are tolerant (``try_cast``): a value that does not fit becomes null
    and, with ``errors_col``, the row lists the columns that failed to cast so a
    quality rule can quarantine it. Missing columns are typed nulls; extra
    columns are dropped (or kept last with ``keep_extra``). The report lists
    what changed; nothing here runs a job.
    """
    have = dict(df.dtypes)
    rep = ConformReport()
    cols, errs = [], {}
    for f in schema.fields:
        t = f.dataType.simpleString()
        if f.name not in have:
            rep.missing.append(f.name)
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f.name)
        if have[f.name] == t:
            cols.append(src)
            continue
        rep.cast.append(f.name)
        casted = src.try_cast(f.dataType)
        cols.append(casted.alias(f.name))
        errs[f.name] = src.isNotNull() & casted.isNull()
    names = {f.name for f in schema.fields}
    rep.extra = [c for c in df.columns if c not in names]
    if keep_extra:
        cols += [F.col(c) for c in rep.extra]
    if errors_col:
        cols.append(names_where(errs).alias(errors_col))
    return df.select(*cols), rep


def check(df: DataFrame, schema: StructType) -> None:
    """Raise if ``df`` does not have exactly the contract's names and types."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if got != want:
        raise ValueError(f"schema differs from contract:\n got  {got}\n want {want}")
