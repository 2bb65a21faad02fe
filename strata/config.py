"""Pipeline configuration: the original JSON layout, validated into frozen dataclasses.

Unknown keys are errors (a typo must not silently disable SCD2); two keys are
added to the original layout, ``pipeline.bucket_count`` and ``pipeline.multi_line``. Keys the
original declares but no job reads (``pipeline.bronze_batch_size``,
``schedule``, ``project``) are accepted and ignored: Spark sizes its own scan
splits, and scheduling belongs to the job runner.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from .operators.scd2 import Scd2Spec

_TOP = {"project", "unity_catalog", "data_files", "pipeline", "scd2", "tables", "schedule"}
_LAYERS = ("landing", "bronze", "silver", "gold")
_SCD2_KEYS = {"enabled", "tracked_tables", "business_keys", "tracked_columns",
              "effective_date_column", "end_date_column", "is_current_column"}
_PIPELINE_KEYS = {"bronze_batch_size", "enable_quality_checks", "enable_quarantine",
                  "bucket_count", "multi_line"}


class ConfigError(ValueError):
    pass


def _only(d: dict, allowed: set, where: str) -> None:
    unknown = set(d) - allowed
    if unknown:
        raise ConfigError(f"unknown key(s) {sorted(unknown)} in {where}")


def _need(d: dict, key: str, where: str):
    if key not in d:
        raise ConfigError(f"missing key {key!r} in {where}")
    return d[key]


@dataclass(frozen=True)
class Scd2Config:
    enabled: bool
    tracked_tables: tuple[str, ...]
    business_keys: dict
    tracked_columns: dict
    effective_date_column: str = "effective_date"
    end_date_column: str = "end_date"
    is_current_column: str = "is_current"


@dataclass(frozen=True)
class PipelineConfig:
    catalog: str
    schemas: dict
    volume_path: str
    data_files: dict
    tables: dict
    scd2: Scd2Config
    quality_checks: bool = True
    quarantine: bool = False
    # > 0: the fact and the item dimension are written in this many buckets on
    # the item key, so the gold star join reads them co-located (no shuffle)
    bucket_count: int = 0
    # per data file: may a record hold line breaks? (true if not named; then a file is one task)
    multi_line: dict = field(default_factory=dict)
    prefix: str | None = None  # database name prefix; default "<catalog>_"
    extra: dict = field(default_factory=dict)

    @staticmethod
    def from_dict(d: dict, prefix: str | None = None) -> "PipelineConfig":
        _only(d, _TOP, "config")
        uc = _need(d, "unity_catalog", "config")
        _only(uc, {"catalog", "schemas", "volume"}, "unity_catalog")
        schemas = _need(uc, "schemas", "unity_catalog")
        for layer in _LAYERS:
            _need(schemas, layer, "unity_catalog.schemas")
        _only(schemas, set(_LAYERS), "unity_catalog.schemas")
        vol = _need(uc, "volume", "unity_catalog")
        tables = _need(d, "tables", "config")
        _only(tables, set(_LAYERS), "tables")
        s = _need(d, "scd2", "config")
        _only(s, _SCD2_KEYS, "scd2")
        tracked = tuple(_need(s, "tracked_tables", "scd2"))
        bkeys = dict(_need(s, "business_keys", "scd2"))
        tcols = dict(_need(s, "tracked_columns", "scd2"))
        for t in tracked:
            if t not in bkeys or t not in tcols:
                raise ConfigError(f"scd2 tracked table {t!r} needs business_keys and "
                                  f"tracked_columns")
        pipe = d.get("pipeline", {})
        _only(pipe, _PIPELINE_KEYS, "pipeline")
        multi = dict(pipe.get("multi_line", {}))
        _only(multi, set(_need(d, "data_files", "config")), "pipeline.multi_line")
        return PipelineConfig(
            multi_line={k: bool(v) for k, v in multi.items()},
            catalog=_need(uc, "catalog", "unity_catalog"),
            schemas=dict(schemas),
            volume_path=_need(vol, "path", "unity_catalog.volume"),
            data_files=dict(_need(d, "data_files", "config")),
            tables={k: dict(v) for k, v in tables.items()},
            scd2=Scd2Config(
                enabled=bool(_need(s, "enabled", "scd2")), tracked_tables=tracked,
                business_keys={k: tuple(v) for k, v in bkeys.items()},
                tracked_columns={k: tuple(v) for k, v in tcols.items()},
                effective_date_column=s.get("effective_date_column", "effective_date"),
                end_date_column=s.get("end_date_column", "end_date"),
                is_current_column=s.get("is_current_column", "is_current")),
            quality_checks=bool(pipe.get("enable_quality_checks", True)),
            quarantine=bool(pipe.get("enable_quarantine", False)),
            bucket_count=int(pipe.get("bucket_count", 0)),
            prefix=prefix,
            extra={k: d[k] for k in ("project", "schedule") if k in d},
        )

    @staticmethod
    def load(path: str, prefix: str | None = None) -> "PipelineConfig":
        with open(path) as f:
            return PipelineConfig.from_dict(json.load(f), prefix)

    def database(self, layer: str) -> str:
        pre = self.prefix if self.prefix is not None else f"{self.catalog}_"
        return f"{pre}{self.schemas[layer]}"

    def table(self, layer: str, key: str) -> str:
        try:
            name = self.tables[layer][key]
        except KeyError:
            raise ConfigError(f"no table {key!r} in layer {layer!r}") from None
        return f"{self.database(layer)}.{name}"

    def scd2_spec(self, key: str) -> Scd2Spec | None:
        """The SCD2 spec of a table, or None: SCD2 applies only when it is enabled
        AND the table is tracked. Silver and gold use this same test."""
        if not (self.scd2.enabled and key in self.scd2.tracked_tables):
            return None
        return Scd2Spec(keys=self.scd2.business_keys[key],
                        tracked=self.scd2.tracked_columns[key],
                        effective=self.scd2.effective_date_column,
                        end=self.scd2.end_date_column,
                        current=self.scd2.is_current_column)


def default_config_dict(volume_path: str, catalog: str = "analytics") -> dict:
    """A config in the original layout with its table names (fixed values)."""
    return {
        "unity_catalog": {
            "catalog": catalog,
            "schemas": {"landing": "landing", "bronze": "bronze", "silver": "silver",
                        "gold": "gold"},
            "volume": {"path": volume_path},
        },
        "data_files": {"raw_reviews": "Drug.csv", "clean_reviews": "Drug_clean.csv"},
        "pipeline": {"enable_quality_checks": True, "enable_quarantine": True},
        "scd2": {
            "enabled": True,
            "tracked_tables": ["dim_drugs"],
            "business_keys": {"dim_drugs": ["drug_name"]},
            "tracked_columns": {"dim_drugs": ["average_price", "drug_type", "drug_form"]},
            "effective_date_column": "effective_date",
            "end_date_column": "end_date",
            "is_current_column": "is_current",
        },
        "tables": {
            "landing": {"metadata_tracking": "metadata_tracking"},
            "bronze": {"drug_reviews_raw": "drug_reviews_raw",
                       "drug_reviews_clean": "drug_reviews_clean"},
            "silver": {"dim_drugs": "dim_drugs", "dim_drugs_history": "dim_drugs_history",
                       "dim_conditions": "dim_conditions",
                       "fact_drug_performance": "fact_drug_performance"},
            "gold": {"drug_effectiveness_ranking": "drug_effectiveness_ranking",
                     "price_performance_analysis": "price_performance_analysis",
                     "condition_treatment_summary": "condition_treatment_summary"},
        },
    }
