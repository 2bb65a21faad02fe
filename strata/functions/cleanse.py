"""Cleansing expressions: pure Column -> Column functions, all JVM-side built-ins.

Nothing here runs Python per row. The keyword categoriser, a Python UDF in the
original pipeline, is a ``CASE WHEN`` chain generated from a rule list, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# These must equal the original pipeline's for equal results.
# Keyword rules, in order; the first rule with a matching word wins, else "Other".
REFERENCE_CATEGORY_RULES: list[tuple[str, list[str]]] = [
    ("Pain Management", ["pain", "ache", "arthritis"]),
    ("Cardiovascular", ["hypertension", "heart", "cardiovascular"]),
    ("Dermatology", ["dermatitis", "skin", "eczema", "psoriasis"]),
    ("Metabolic", ["diabetes", "glucose"]),
    ("Infectious Disease", ["infection", "bacterial", "viral"]),
    ("Rheumatology", ["gout", "uric"]),
    ("Gastrointestinal", ["reflux", "gerd", "gastro"]),
]
REFERENCE_CATEGORY_OTHER = "Other"
# Label used for a missing type / form.
UNKNOWN = "Unknown"
# ---------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def leading_int(c: ColumnOrName) -> Column:
    """Leading digits of a text as int: '1,234 Reviews' -> 1, 'none' -> null, overflow -> null."""
    return F.regexp_extract(_col(c), r"^([0-9]+)", 1).try_cast("int")


def tolerant(c: ColumnOrName, dtype: str) -> Column:
    """Cast that yields null on bad or overflowing input instead of failing."""
    return _col(c).try_cast(dtype)


def strict_int(c: ColumnOrName) -> Column:
    """double -> int by truncation toward zero; overflow fails under ANSI mode."""
    return _col(c).cast("int")


def strip_crlf(c: ColumnOrName) -> Column:
    """Remove embedded line breaks, CR LF or LF.

    Only a multi-line CSV read can put a line break inside a field, and Spark's
    multi-line parser hands a quoted CR LF over as LF, so both forms are removed.
    """
    return F.regexp_replace(_col(c), "\r?\n", "")


def trim_spaces(c: ColumnOrName) -> Column:
    """Strip leading/trailing spaces (spaces only, as SQL TRIM does)."""
    return F.trim(_col(c))


def title_case(c: ColumnOrName) -> Column:
    """initcap(trim(x)): each whitespace-delimited word capitalised, the rest lowered."""
    return F.initcap(F.trim(_col(c)))


def label(c: ColumnOrName, default: str = UNKNOWN, empty_is_missing: bool = True) -> Column:
    """Trimmed label with a default for null (and, by default, empty) text."""
    t = F.trim(strip_crlf(c))
    if empty_is_missing:
        t = F.when(t == "", F.lit(None)).otherwise(t)
    return F.coalesce(t, F.lit(default))


def names_where(conditions: Mapping[str, Column]) -> Column:
    """The names whose condition is TRUE, in order, as an array.

    Joined from constant arrays: ``array_compact`` is a lambda, which Spark interprets row by row
    outside generated code, and with it every cast inside the conditions.
    """
    none = F.array().cast("array<string>")
    parts = [F.when(c, F.array(F.lit(n))).otherwise(none) for n, c in conditions.items()]
    return F.concat(*parts) if parts else none


def categorise(c: ColumnOrName, rules: Sequence[tuple[str, Sequence[str]]] | None = None,
               otherwise: str = REFERENCE_CATEGORY_OTHER, whole_word: bool = False) -> Column:
    """Ordered keyword rules over the lower-cased text; first matching rule wins.

    Matching is by substring (so 'trachea' hits 'ache'), as in the original;
    ``whole_word=True`` matches whole words instead. Null text gets ``otherwise``.
    """
    rules = REFERENCE_CATEGORY_RULES if rules is None else rules
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    out = None
    for category, words in rules:
        if whole_word:
            pattern = r"\b(" + "|".join(re.escape(w.lower()) for w in words) + r")\b"
            hit = text.rlike(pattern)
        else:
            hit = None
            for w in words:
                h = text.contains(w.lower())
                hit = h if hit is None else (hit | h)
        out = F.when(hit, F.lit(category)) if out is None else out.when(hit, F.lit(category))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NON_WORD = re.compile(r"[^0-9a-zA-Z]+")


def to_snake(name: str) -> str:
    """Header normaliser: 'Ease of Use', 'easeOfUse', 'ease-of-use' -> 'ease_of_use'."""
    s = _CAMEL.sub("_", name.strip())
    s = _NON_WORD.sub("_", s).strip("_")
    return s.lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``to_snake``; fails on a name collision."""
    names = [to_snake(c) for c in df.columns]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"header names collide after normalising: {sorted(dup)}")
    return df.toDF(*names)
