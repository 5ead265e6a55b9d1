"""Duplicates and distinct (A1–A5) and column presence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def atomic_columns(df: DataFrame) -> list[str]:
    """Columns whose type is not nested (map, array, struct)."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, ArrayType, StructType))]


def count_duplicates(df: DataFrame, atomic_only: bool = True) -> DataFrame:
    """A1/A2: number of extra copies (first copy not counted) over the
    atomic columns (or all columns).  One row ``duplicados``.  Partial
    aggregation combines copies on the map side before the shuffle."""
    cols = atomic_columns(df) if atomic_only else df.columns
    g = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicados"))


def select_present(df: DataFrame, wanted):
    """Select the wanted columns that exist; report the missing ones.
    Returns ``(frame or None, missing)``; no wanted column present → None."""
    present = [c for c in wanted if c in df.columns]
    missing = [c for c in wanted if c not in df.columns]
    if not present:
        return None, missing
    return df.select(*[F.col(f"`{c}`") for c in present]), missing
