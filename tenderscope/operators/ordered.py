"""Rank, dense rank and running totals inside groups, without putting a group
in one task.

A window ``partitionBy(group).orderBy(value)`` sends each group to a single
task.  Here the rows are first counted per (group, value), which combines ties
map-side.  Each group's values are then cut into at most ``SPLITS`` + 1 buckets
at split points drawn from the values themselves: the ones with the smallest
hashes, a deterministic sample that the window-group limit takes map-side.  A
row's bucket is a pure function of its group and value, so it does not matter
how Spark partitions, reuses or recomputes anything.  Running totals inside a
bucket, plus the totals of the buckets before it (at most ``SPLITS`` + 1 rows a
group), are the group-wide ones; they are joined back on (group, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import join_on_keys, keys_list

SPLITS = 255


def value_totals(df: DataFrame, part, value: str, descending: bool = True) -> DataFrame:
    """One row per (group, value) in the given order: ``_n`` rows that hold it,
    ``_n0`` / ``_d0`` / ``_s0`` rows, distinct values and value sum before it,
    ``_all`` rows of the group.  Null values come last either way."""
    part = keys_list(part)
    v = df.groupBy(*part, F.col(value).alias("_val")).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.row_number().over(Window.partitionBy(*part).orderBy(F.xxhash64("_val"), "_val"))
    cuts = v.where("_val is not null").withColumn("_pick", pick).where(F.col("_pick") <= SPLITS)
    cuts = cuts.groupBy(*part).agg(F.collect_list("_val").alias("_cuts"))
    side = (lambda x: x > F.col("_val")) if descending else (lambda x: x < F.col("_val"))
    bucket = F.when(F.col("_val").isNull(), F.lit(SPLITS + 1)).otherwise(F.size(F.filter(F.coalesce("_cuts", F.expr("array()")), side)))
    v = join_on_keys(v, cuts, part, "left").withColumn("_b", bucket).drop("_cuts")
    v = v.withColumn("_s", F.coalesce(F.col("_val") * F.col("_n"), F.lit(0)))
    blocks = v.groupBy(*part, "_b").agg(F.sum("_n").alias("_bn"), F.count(F.lit(1)).alias("_bd"), F.sum("_s").alias("_bs"))
    group, first = Window.partitionBy(*part), Window.unboundedPreceding
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(first, -1)), F.lit(0))
    blocks = blocks.select(*part, "_b", *[before(c, group.orderBy("_b")).alias(f"_o{c[2:]}") for c in ("_bn", "_bd", "_bs")],
                           F.sum("_bn").over(group).alias("_all"))
    order = F.col("_val").desc_nulls_last() if descending else F.col("_val").asc_nulls_last()
    inside = Window.partitionBy(*part, "_b").orderBy(order)
    v = v.select(*part, "_b", "_val", "_n", before("_n", inside).alias("_ln"), (F.row_number().over(inside) - 1).alias("_ld"),
                 before("_s", inside).alias("_ls"))
    return join_on_keys(v, blocks, [*part, "_b"]).select(
        *part, "_val", "_n", (F.col("_on") + F.col("_ln")).alias("_n0"), (F.col("_od") + F.col("_ld")).alias("_d0"),
        (F.col("_os") + F.col("_ls")).alias("_s0"), "_all")


def ordered_stats(df: DataFrame, part, value: str) -> DataFrame:
    """Adds ``_rank`` (competition rank, 1 = largest), ``_dense`` (dense rank)
    and ``_cum`` (sum of the group's values >= this one, ties included):
    exactly what ``rank()``, ``dense_rank()`` and a descending range frame
    give over ``partitionBy(part)``."""
    part = keys_list(part)
    t = value_totals(df, part, value)
    t = t.select(*part, F.col("_val").alias(value), (F.col("_n0") + 1).alias("_rank"), (F.col("_d0") + 1).alias("_dense"),
                 (F.col("_s0") + F.coalesce(F.col("_val") * F.col("_n"), F.lit(0))).alias("_cum"))
    return join_on_keys(df, t, [*part, value])
