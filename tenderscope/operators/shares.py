"""Share measures H1–H3.

DAX context rules are kept explicit: the operators take the *sliced* fact
(what the visual shows) and the *unsliced* fact (what ``ALL`` / ``ALLEXCEPT``
see) as two inputs; the divisor is never derived from the sliced rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import join_on_keys, keys_list, money, ratio


def share_of_total(sliced: DataFrame, unsliced: DataFrame, by=(), value: str = "valor") -> DataFrame:
    """H1: value / total of the whole unsliced fact (one-row divisor)."""
    by = keys_list(by)
    g = sliced.groupBy(*by).agg(F.sum(value).alias("_v"))
    tot = unsliced.agg(F.sum(value).alias("_t"))
    j = join_on_keys(g, tot, [])
    return j.select(*by, money("_v").alias("valor_total"),
                    ratio(F.try_divide(F.col("_v").cast("double"), F.col("_t").cast("double"))).alias("pct_total"))


def share_of_category(sliced: DataFrame, unsliced: DataFrame, by=(), value: str = "valor",
                      category: str = "categoria_ia") -> DataFrame:
    """H2: value / the category's all-time total (every other filter lifted).
    Without the category in ``by`` the divisor is the grand total."""
    by = keys_list(by)
    g = sliced.groupBy(*by).agg(F.sum(value).alias("_v"))
    if category in by:
        tot = unsliced.groupBy(category).agg(F.sum(value).alias("_t"))
        j = join_on_keys(g, tot, [category], "left")
    else:
        j = join_on_keys(g, unsliced.agg(F.sum(value).alias("_t")), [])
    return j.select(*by, money("_v").alias("valor_total"),
                    ratio(F.try_divide(F.col("_v").cast("double"), F.col("_t").cast("double"))).alias("pct_categoria"))


def share_of_year(sliced: DataFrame, by=(), value: str = "valor", year: str = "ano") -> DataFrame:
    """H3: value / the year's total for the same non-calendar keys.  Calendar
    filters other than the year are lifted; fact filters stay, so the divisor
    comes from the same (sliced) rows, summed over the year.  Without the year
    in ``by`` the divisor spans all years."""
    by = keys_list(by)
    g = sliced.groupBy(*by).agg(F.sum(value).alias("_v"))
    cal_cols = {year, "mes", "Mes", "MesNum", "trimestre"}
    part = [k for k in by if k not in cal_cols] + ([year] if year in by else [])
    # the divisor window runs over the aggregated rows (≤ #months per key)
    w = Window.partitionBy(*part) if part else Window.partitionBy()
    return g.select(*by, money("_v").alias("valor_total"),
                    ratio(F.try_divide(F.col("_v").cast("double"), F.sum("_v").over(w).cast("double"))).alias("pct_ano"))
