"""Column-level functions (all JVM-side built-ins)."""

from .cleanse import (REFERENCE_CATEGORY_RULES, UNKNOWN, categorise, label, leading_int,
                      snake_columns, strict_int, strip_crlf, title_case, to_snake, tolerant,
                      trim_spaces)
from .keys import composite_key, hash_key, record_id, with_lineage
from .scoring import (REFERENCE_PRICE_TIERS, REFERENCE_SCORE_WEIGHTS, exact_avg, guarded_ratio,
                      percentile_of, tier, weighted_score)

__all__ = [
    "REFERENCE_CATEGORY_RULES", "REFERENCE_PRICE_TIERS", "REFERENCE_SCORE_WEIGHTS", "UNKNOWN",
    "categorise", "composite_key", "exact_avg", "guarded_ratio", "hash_key", "label",
    "leading_int", "percentile_of", "record_id", "snake_columns", "strict_int", "strip_crlf",
    "tier", "title_case", "to_snake", "tolerant", "trim_spaces", "weighted_score",
    "with_lineage",
]
