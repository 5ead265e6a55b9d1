"""Data-quality measures D1–D5, D8 and presentation values D6–D7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fmt import brl_compact
from .util import join_on_keys, keys_list, ratio

# The two labels the classifier gives when it cannot categorise,
# and the YoY colours (up, down, none).
NO_DESCRIPTION = "Sem Descrição"
NEEDS_REVIEW = "Outros / Necessita Revisão"
COLOUR_UP, COLOUR_DOWN, COLOUR_FLAT = "#16A34A", "#DC2626", "#71717A"


def is_uncategorised(col="categoria_ia"):
    c = F.col(col)
    return c.isNull() | c.isin(NO_DESCRIPTION, NEEDS_REVIEW)


def uncategorised(sliced: DataFrame, by=(), category: str = "categoria_ia", unsliced_by_category: DataFrame | None = None) -> DataFrame:
    """D1/D2.  The measure *replaces* any category filter, so with the category
    in ``by`` every category row shows the count over all categories (for the
    row's other keys); ``unsliced_by_category`` is the fact before any
    category slicer (defaults to ``sliced``)."""
    by = keys_list(by)
    base = unsliced_by_category if unsliced_by_category is not None else sliced
    other = [k for k in by if k != category]
    rows = sliced.groupBy(*by).agg(F.count(F.lit(1)).alias("qtd_linhas"))
    bad = base.groupBy(*other).agg(F.count_if(is_uncategorised(category)).alias("qtd_sem_categoria"))
    j = join_on_keys(rows, bad, other, "left")
    return j.select(*by, "qtd_linhas", F.coalesce("qtd_sem_categoria", F.lit(0)).alias("qtd_sem_categoria"),
                    ratio(F.lit(1.0) - F.coalesce(F.try_divide(F.coalesce("qtd_sem_categoria", F.lit(0)).cast("double"), F.col("qtd_linhas").cast("double")), F.lit(0.0))).alias("pct_bem_categorizados"))


def mean_confidence(mapa: DataFrame) -> DataFrame:
    """D3: mean confidence over the map rows (fact slicers do not reach it)."""
    return mapa.agg(ratio(F.avg("confianca")).alias("confianca_media"))


def low_confidence(fact: DataFrame, mapa: DataFrame, by=(), lo: float = 0.0, hi: float = 0.5) -> DataFrame:
    """Fact rows whose mapped description has lo < confidence < hi."""
    by = keys_list(by)
    keys = mapa.where((F.col("confianca") > lo) & (F.col("confianca") < hi)).select("descricao_original")
    flagged = fact.join(keys.withColumn("_low", F.lit(1)), on="descricao_original", how="left")
    g = flagged.groupBy(*by).agg(F.count(F.lit(1)).alias("qtd_linhas"), F.count("_low").alias("qtd_baixa_confianca"))
    return g.select(*by, "qtd_baixa_confianca",
                    ratio(F.try_divide(F.col("qtd_baixa_confianca").cast("double"), F.col("qtd_linhas").cast("double"))).alias("pct_baixa_confianca"))


def quality_panel(fact: DataFrame, mapa: DataFrame) -> DataFrame:
    """Per map category, fact rows mapped to it and the mean confidence of
    the map rows in it, lowest confidence first."""
    m = mapa.select("descricao_original", F.col("categoria_ia").alias("categoria_mapa"), "confianca")
    rows = fact.join(m.select("descricao_original", "categoria_mapa"), on="descricao_original").groupBy("categoria_mapa").agg(
        F.count(F.lit(1)).alias("qtd_linhas"))
    conf = m.groupBy("categoria_mapa").agg(ratio(F.avg("confianca")).alias("confianca_media"))
    return conf.join(rows, on="categoria_mapa", how="left").orderBy("confianca_media", "categoria_mapa")


def yoy_colour(pct_col="yoy_pct"):
    """Green up, red down, grey for null or zero."""
    p = F.col(pct_col)
    return F.when(p > 0, F.lit(COLOUR_UP)).when(p < 0, F.lit(COLOUR_DOWN)).otherwise(F.lit(COLOUR_FLAT))


def formatted_total(col):
    """D6."""
    return brl_compact(col)
