"""Row filters: periods (P15) and dashboard slicers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_period(df: DataFrame, start=None, end=None, date_col: str = "mes") -> DataFrame:
    """Inclusive date range; either end may be open.  Pushed to the scan."""
    c = F.col(date_col)
    if start is not None:
        df = df.where(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(c <= F.lit(end).cast("date"))
    return df


def apply_slicers(df: DataFrame, categories=None, months=None, suppliers=None) -> DataFrame:
    """Multi-select slicers; an empty or missing selection means no filter."""
    if categories:
        df = df.where(F.col("categoria_ia").isin(list(categories)))
    if months:
        df = df.where(F.col("mes").isin([F.lit(m).cast("date") for m in months]))
    if suppliers:
        df = df.where(F.col("nome").isin(list(suppliers)))
    return df


def with_month(df: DataFrame, label: str | Column, col: str = "mes/ano") -> DataFrame:
    """The month label (``MM/yyyy``; a text for one month's pull, a column
    for several) as the first column."""
    return df.select((F.lit(label) if isinstance(label, str) else label).alias(col), "*")


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """P10: the named columns cast to the given types; a value that does not
    read as its type, or overflows it, becomes null."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items()})
