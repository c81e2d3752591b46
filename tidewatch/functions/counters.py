"""Counter text such as ``'1,077 stars today'`` or ``'1.2k stars'`` to integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed value: counter text pattern (case-insensitive search) ----
COUNTER_PATTERN = r"(?i)([\d,\.]+)\s*(k|K)?\s*stars?"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_counter(c: str | Column) -> Column:
    """Number before ``star(s)``; commas dropped, ``k`` x 1000, truncated.

    No match or a malformed number gives null (P5).
    """
    text = F.coalesce(_col(c), F.lit(""))
    matched = text.rlike(COUNTER_PATTERN)
    num = F.replace(F.regexp_extract(text, COUNTER_PATTERN, 1), F.lit(","), F.lit("")).try_cast("double")
    factor = F.when(F.regexp_extract(text, COUNTER_PATTERN, 2) != "", F.lit(1000.0)).otherwise(F.lit(1.0))
    return F.when(matched, (num * factor).try_cast("bigint"))


def counter_or_zero(c: str | Column) -> Column:
    """Same parse with 0 for anything unparsed."""
    return F.coalesce(parse_counter(c), F.lit(0).cast("bigint"))
