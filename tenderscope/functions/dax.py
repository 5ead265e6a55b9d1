"""Blank-aware arithmetic that the BI measures rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def div(a, b) -> Column:
    """DIVIDE: null when the divisor is 0 or null."""
    return F.try_divide(_c(a), _c(b))


def bsub(a, b) -> Column:
    """``a - b`` where a blank side counts as 0; blank only if both are blank."""
    if isinstance(a, str) and isinstance(b, str) and a.replace("_", "").isalnum() and b.replace("_", "").isalnum():
        return F.expr(f"CASE WHEN `{a}` IS NULL AND `{b}` IS NULL THEN NULL ELSE coalesce(`{a}`, 0) - coalesce(`{b}`, 0) END")
    a, b = _c(a), _c(b)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
    )


def distinct_count_blank(col) -> Column:
    """DISTINCTCOUNT: distinct values, a blank (null) counts as one more value."""
    c = _c(col)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
