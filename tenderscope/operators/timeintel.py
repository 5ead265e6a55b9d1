"""Time intelligence T1–T9 on a gap-free monthly spine.

Shifts are calendar shifts: the monthly totals are left-joined onto a spine
that has every calendar month for every key, so ``lag(v, 12)`` over the
spine is "same month last year" even when a month has no data.  All windows
run after aggregation, over at most (#months) rows per key: a hot key is
pre-aggregated on the map side before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dax import bsub
from .calendar import month_spine
from .util import join_on_keys, keys_list, money, month_seq, ratio, with_one_row


def monthly_values(fact: DataFrame, keys=(), value: str = "valor") -> DataFrame:
    keys = keys_list(keys)
    return fact.groupBy(*keys, "mes").agg(F.sum(value).alias("v"))


def on_spine(fact: DataFrame, keys=(), end: str = "edate7", value: str = "valor") -> DataFrame:
    """Monthly totals on the calendar spine × distinct keys; empty months are
    null (blank), not 0.  Columns: keys, mes, ano, mseq, v."""
    keys = keys_list(keys)
    m = monthly_values(fact, keys, value)
    if keys:
        # one row per key with the calendar range attached; the spine is
        # generated per key with explode (no pair expansion through a join)
        from .calendar import bounds
        b = bounds(m, end=end)
        grid = with_one_row(m.select(*keys).distinct(), b).select(
            *keys, F.explode(F.sequence(F.trunc("d0", "MM"), F.trunc("d1", "MM"), F.expr("interval 1 month"))).alias("mes")
        )
        g = _null_safe_left(grid, m, keys)
    else:
        g = month_spine(m, end=end).join(m, on="mes", how="left")
    return g.select(*keys, "mes", F.year("mes").alias("ano"), month_seq("mes").alias("mseq"), "v")


def _null_safe_left(grid: DataFrame, m: DataFrame, keys) -> DataFrame:
    return join_on_keys(grid, m, [*keys, "mes"], "left")


def time_intelligence(fact: DataFrame, keys=(), end: str = "edate7") -> DataFrame:
    """All monthly T measures.  Output columns (money rounded, ratios 6dp):
    keys, mes, ano, valor_total, valor_ano_anterior, delta_yoy, yoy_pct,
    valor_mes_anterior, delta_mom, mom_pct, valor_ytd, valor_ytd_ano_anterior,
    valor_12m."""
    keys = keys_list(keys)
    g = on_spine(fact, keys, end)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("mseq")
    wy = Window.partitionBy(*keys, "ano").orderBy("mseq").rowsBetween(Window.unboundedPreceding, 0)
    t = g.select(
        *keys, "mes", "ano", "mseq", "v",
        F.lag("v", 12).over(w).alias("py"),
        F.lag("v", 1).over(w).alias("pm"),
        F.sum("v").over(wy).alias("ytd"),
        F.sum("v").over(w.rangeBetween(-11, 0)).alias("r12"),
    )
    t = t.select("*", F.lag("ytd", 12).over(w).alias("pytd"))
    return t.select(
        *keys, "mes", F.col("ano").cast("bigint").alias("ano"),
        money("v").alias("valor_total"),
        money("py").alias("valor_ano_anterior"),
        money(bsub("v", "py")).alias("delta_yoy"),
        ratio(F.try_divide(bsub("v", "py").cast("double"), F.col("py").cast("double"))).alias("yoy_pct"),
        money("pm").alias("valor_mes_anterior"),
        money(bsub("v", "pm")).alias("delta_mom"),
        ratio(F.try_divide(bsub("v", "pm").cast("double"), F.col("pm").cast("double"))).alias("mom_pct"),
        money("ytd").alias("valor_ytd"),
        money("pytd").alias("valor_ytd_ano_anterior"),
        money("r12").alias("valor_12m"),
    )


def yoy_yearly(fact: DataFrame, keys=(), end: str = "edate7") -> DataFrame:
    """T1–T3 at year grain: the prior-year value of a year is the sum of the
    lagged months the calendar holds for that year."""
    keys = keys_list(keys)
    g = on_spine(fact, keys, end)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("mseq")
    t = g.select(*keys, "ano", "v", F.lag("v", 12).over(w).alias("py"))
    y = t.groupBy(*keys, "ano").agg(F.sum("v").alias("v"), F.sum("py").alias("py"))
    return y.select(
        *keys, F.col("ano").cast("bigint").alias("ano"),
        money("v").alias("valor_total"),
        money("py").alias("valor_ano_anterior"),
        money(bsub("v", "py")).alias("delta_yoy"),
        ratio(F.try_divide(bsub("v", "py").cast("double"), F.col("py").cast("double"))).alias("yoy_pct"),
    )
