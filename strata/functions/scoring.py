"""Scores, tiers, ratios and repeatable averages (Column expressions)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleanse import ColumnOrName, _col

# ---------------------------------------------------------------------------
# Fixed values of the original marts.
REFERENCE_SCORE_WEIGHTS = {"effectiveness_score": 0.4, "satisfaction_score": 0.4,
                           "ease_of_use_score": 0.2}
REFERENCE_PRICE_TIERS = [(50.0, "Low (<$50)"), (150.0, "Medium ($50-$150)")]
REFERENCE_PRICE_TIER_TOP = "High (>$150)"
# ---------------------------------------------------------------------------


def weighted_score(weights: Mapping[str, float] | None = None, scale: int = 2,
                   reweight_missing: bool = False) -> Column:
    """round(sum(w_i * coalesce(x_i, 0)), scale), HALF_UP.

    A missing measure counts as 0, as in the original. With
    ``reweight_missing=True`` the weights of present measures are rescaled to
    sum to 1 instead (null when all are missing).
    """
    weights = dict(REFERENCE_SCORE_WEIGHTS if weights is None else weights)
    total = None
    for c, w in weights.items():
        term = F.coalesce(F.col(c), F.lit(0.0)) * F.lit(float(w))
        total = term if total is None else total + term
    if reweight_missing:
        present = None
        for c, w in weights.items():
            t = F.when(F.col(c).isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0))
            present = t if present is None else present + t
        total = F.when(present > 0, total / present * F.lit(float(sum(weights.values()))))
    return F.round(total, scale)


def tier(c: ColumnOrName, bands: Sequence[tuple[float, str]] | None = None,
         top: str | None = None) -> Column:
    """First band whose limit the value is strictly below; else ``top``.

    Bands must be ascending. A value equal to a limit goes to the next band
    (exactly 150 is 'High', as in the original). Null -> ``top`` as well.
    """
    if bands is None:
        bands, top = REFERENCE_PRICE_TIERS, REFERENCE_PRICE_TIER_TOP
    limits = [b[0] for b in bands]
    if limits != sorted(limits):
        raise ValueError("tier bands must be ascending")
    x = _col(c)
    out = None
    for limit, name in bands:
        cond = x < F.lit(float(limit))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(top))


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, factor: float = 100.0,
                  scale: int = 4) -> Column:
    """round(den > 0 ? coalesce(num, 0) / den * factor : 0, scale)."""
    d = _col(den)
    return F.round(
        F.when(d > 0, F.coalesce(_col(num), F.lit(0.0)) / d * F.lit(float(factor)))
        .otherwise(F.lit(0.0)), scale)


# --- averages that do not depend on the order of summation ---------------------------
#
# A finite double is cut, exactly, into whole numbers: its integer part and LIMBS
# groups of LIMB_BITS bits behind the point. The integer part is summed as a decimal of
# 38 digits, the groups as bigint (8.8e12 rows before one could overflow), so any
# order of partial aggregation gives the same sums and parts add up across
# pre-aggregates. What lies below the last group (2^-80), NaN, infinities and values from
# 2^62 on are summed as doubles beside them: nothing is dropped, and only digits that far
# below one, or sums of huge values, can depend on the order, in their last place.
LIMBS, LIMB_BITS = 4, 20
_HUGE = 2.0 ** 62
_WHOLE = "decimal(38,0)"
PARTS = [f"s{k}" for k in range(LIMBS + 1)] + ["sr", "sx", "cnt"]


def double_parts(c: ColumnOrName) -> dict[str, Column]:
    """The parts of one value: whole numbers s0..s4, ``sr`` for what is below them, ``sx`` for what is not
    finite or huge, ``cnt``."""
    x = _col(c).cast("double")
    huge = F.abs(x) >= F.lit(_HUGE)          # true for NaN, which sorts above everything
    rest = F.when(~huge, x)
    out = {}
    for k in range(LIMBS + 1):
        whole = rest.cast("long")            # towards zero, so what is left is exact
        out[f"s{k}"] = whole if k else whole.cast("decimal(20,0)")
        rest = (rest - whole.cast("double")) * F.lit(2.0 ** LIMB_BITS)
    out["sr"] = rest * F.lit(2.0 ** (-LIMB_BITS * (LIMBS + 1)))
    out["sx"] = F.when(huge, x)
    out["cnt"] = F.when(x.isNotNull(), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return out


def summed_parts(c: ColumnOrName, prefix: str) -> list[Column]:
    """Aggregates ``<prefix>_s0 ... <prefix>_cnt`` from which ``parts_avg`` makes the average."""
    return [_summed(k, v).alias(f"{prefix}_{k}") for k, v in double_parts(c).items()]


def _summed(part: str, c: Column | str) -> Column:
    return F.sum(c).cast(_WHOLE) if part == "s0" else F.sum(c)


def add_parts(prefix: str) -> dict[str, Column]:
    """Sums of parts that were summed before."""
    return {k: _summed(k, f"{prefix}_{k}") for k in PARTS}


def parts_total(parts: Mapping[str, Column]) -> Column:
    """The double that summed parts stand for; null without a value."""
    low = F.coalesce(parts["sr"], F.lit(0.0))
    for k in range(LIMBS, 0, -1):
        low = F.coalesce(parts[f"s{k}"], F.lit(0)).cast("double") * F.lit(2.0 ** (-LIMB_BITS * k)) + low
    total = F.coalesce(parts["sx"], F.lit(0.0)) + (F.coalesce(parts["s0"], F.lit(0)).cast("double") + low)
    return F.when(parts["cnt"] > 0, total)


def parts_avg(parts: Mapping[str, Column]) -> Column:
    """Average of summed parts, divided once; null without a value."""
    return parts_total(parts) / F.when(parts["cnt"] > 0, parts["cnt"])


def exact_total(c: ColumnOrName) -> Column:
    """Sum (aggregate) that does not depend on the order of rows; null without a value."""
    return parts_total({k: _summed(k, v) for k, v in double_parts(c).items()})


def exact_avg(c: ColumnOrName) -> Column:
    """Average (aggregate) of full doubles that does not depend on the order of rows."""
    return parts_avg({k: _summed(k, v) for k, v in double_parts(c).items()})


def percentile_of(position: ColumnOrName, total: ColumnOrName) -> Column:
    """int(round(position / total * 100, 0)): 1-based position -> 0..100."""
    return F.round(_col(position) / _col(total) * F.lit(100), 0).cast("int")
