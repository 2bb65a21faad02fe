"""Data-quality rules: named boolean Columns, a quarantine split and rule counts.

A rule is a Column that is TRUE for a good row. A rule that evaluates to NULL
counts as failed (unknown is not proof of quality). All checks are computed in
the same pass as the data (no extra scan): ``flag`` adds a ``failed_rules``
array, ``split`` filters on it, and ``counts`` is one aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cleanse import names_where

FAILED = "failed_rules"


def _failed(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(False))


def flag(df: DataFrame, rules: Mapping[str, Column], col: str = FAILED) -> DataFrame:
    """Add ``failed_rules``: names of the rules the row fails, in rule order."""
    return df.withColumn(col, names_where({n: _failed(r) for n, r in rules.items()}))


def observe(df: DataFrame, rules: Mapping[str, Column], observation: Observation) -> DataFrame:
    """``df`` whose first write or collect also collects what ``counts`` returns (no extra job)."""
    return df.observe(observation, *_count_exprs(rules))


def split(df: DataFrame, rules: Mapping[str, Column],
          observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows + ``failed_rules``); the two partition the input.

    With an ``observation`` the per-rule failure counts are collected while
    the valid side is written (no extra job).
    """
    flagged = flag(df, rules)
    if observation is not None:
        flagged = observe(flagged, rules, observation)
    valid = flagged.filter(F.size(FAILED) == 0).drop(FAILED)
    bad = flagged.filter(F.size(FAILED) > 0)
    return valid, bad


def _count_exprs(rules: Mapping[str, Column]) -> list[Column]:
    any_failed = None
    for r in rules.values():
        f = _failed(r)
        any_failed = f if any_failed is None else (any_failed | f)
    out = [F.count(F.lit(1)).alias("rows")]
    out += [F.count_if(_failed(r)).alias(f"failed_{n}") for n, r in rules.items()]
    if any_failed is not None:
        out += [F.count_if(any_failed).alias("quarantined_rows"),
                F.count_if(~any_failed).alias("valid_rows")]
    return out


def counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: total rows, failures per rule, quarantined and valid rows."""
    return df.agg(*_count_exprs(rules))


def enforce(df: DataFrame, rules: Mapping[str, Column], policy: str = "warn",
            max_failed: int = 0) -> tuple[DataFrame, dict]:
    """Apply a policy eagerly: "fail" raises when more than ``max_failed`` rows
    fail, "drop" keeps the valid rows, "warn" keeps all rows. Runs one
    aggregate job to get the counts (returned as a dict)."""
    if policy not in ("fail", "drop", "warn"):
        raise ValueError("policy must be fail, drop or warn")
    stats = counts(df, rules).first().asDict()
    failed = stats.get("quarantined_rows", 0)
    if policy == "fail" and failed > max_failed:
        raise ValueError(f"{failed} rows fail data-quality rules: {stats}")
    if policy == "drop":
        return split(df, rules)[0], stats
    return df, stats
