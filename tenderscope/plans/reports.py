"""Report queries V1–V8: what the three dashboard pages ask of the star.

Each takes the sliced fact (``apply_slicers`` applied) and, where a measure
lifts filters, the unsliced fact too."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dax import distinct_count_blank
from ..functions.fmt import brl_compact
from ..operators.ordered import ordered_stats
from ..operators.util import join_on_keys, materialize, money, ratio


def kpi_cards(sliced: DataFrame) -> DataFrame:
    """V1: formatted total, tenders, suppliers, ticket (one row)."""
    a = sliced.agg(F.sum("valor").alias("_v"), distinct_count_blank("id").alias("qtd_licitacoes"),
                   distinct_count_blank("cpfCnpjVencedor").alias("qtd_fornecedores"))
    return a.select(brl_compact("_v").alias("valor_total_fmt"), "qtd_licitacoes", "qtd_fornecedores",
                    ratio(F.try_divide(F.col("_v").cast("double"), F.col("qtd_licitacoes"))).alias("ticket_medio"))


def _with_total_share(g: DataFrame, unsliced: DataFrame) -> DataFrame:
    tot = unsliced.agg(F.sum("valor").alias("_t"))
    return join_on_keys(g, tot, [])


def _with_total_row(sliced: DataFrame, keys: list[str]) -> DataFrame:
    """Tenders, items and value per key, and their total row (``linha_total`` 1,
    keys null).  The rows are combined once to one per (keys, tender), a blank
    tender being one of them; both levels count and sum those, so no row is
    written twice."""
    part = sliced.groupBy(*keys, "id").agg(F.sum("quantidade").alias("_q"), F.sum("valor").alias("_v"))
    level = [F.count(F.lit(1)).alias("qtd_licitacoes"), F.sum("_q").alias("qtd_itens"), F.sum("_v").alias("_v")]
    each = part.groupBy(*keys).agg(*level).withColumn("linha_total", F.lit(0).cast("bigint"))
    tenders = part.groupBy("id").agg(F.sum("_q").alias("_q"), F.sum("_v").alias("_v"))
    nothing = [F.lit(None).cast(sliced.schema[k].dataType).alias(k) for k in keys]
    return each.unionByName(tenders.agg(*level).select(*nothing, "*", F.lit(1).cast("bigint").alias("linha_total")))


def supplier_table(sliced: DataFrame, unsliced: DataFrame, with_total: bool = False) -> DataFrame:
    """V3 (M16 with ``with_total``): name, tenders, value, share of the overall
    total; the total row, recomputed from the base rows, has a null name."""
    if with_total:
        g = _with_total_row(sliced, ["nome"])
    else:
        g = sliced.groupBy("nome").agg(distinct_count_blank("id").alias("qtd_licitacoes"), F.sum("valor").alias("_v"))
    j = _with_total_share(g, unsliced)
    return j.select("nome", *(["linha_total"] if with_total else []), "qtd_licitacoes", money("_v").alias("valor_total"),
                    ratio(F.try_divide(F.col("_v").cast("double"), F.col("_t").cast("double"))).alias("pct_total"))


def category_bar(sliced: DataFrame) -> DataFrame:
    """V4: value by category, largest first."""
    g = sliced.groupBy("categoria_ia").agg(F.sum("valor").alias("_v"))
    return g.orderBy(F.desc("_v"), F.asc("categoria_ia")).select("categoria_ia", money("_v").alias("valor_total"))


def category_by_year(sliced: DataFrame) -> DataFrame:
    """V5: value by year and category (the line chart's series)."""
    g = sliced.groupBy(F.year("mes").cast("bigint").alias("ano"), "categoria_ia").agg(F.sum("valor").alias("_v"))
    return g.select("ano", "categoria_ia", money("_v").alias("valor_total"))


def category_year_pivot(sliced: DataFrame, categories=None) -> DataFrame:
    """V5, pivoted: one column per category.  Pass ``categories`` when known
    (avoids the extra distinct job Spark runs to find the pivot values)."""
    base = sliced.select(F.year("mes").cast("bigint").alias("ano"), "categoria_ia", "valor")
    p = base.groupBy("ano").pivot("categoria_ia", categories).agg(F.sum("valor"))
    return p.select("ano", *[money(F.col(f"`{c}`")).alias(c) for c in p.columns if c != "ano"])


def _detail_cols(tot_col="_t"):
    return [
        "qtd_licitacoes", "qtd_itens", money("_v").alias("valor_total"),
        ratio(F.try_divide(F.col("_v").cast("double"), F.col("qtd_licitacoes"))).alias("ticket_medio"),
        ratio(F.try_divide(F.col("_v").cast("double"), F.col(tot_col).cast("double"))).alias("pct_total"),
    ]


def category_detail(sliced: DataFrame, unsliced: DataFrame, with_total: bool = False) -> DataFrame:
    """V6 (M16 with ``with_total``): tenders, items, value, ticket, share by
    category, ascending by name; the total row is recomputed from the base
    rows (distinct counts stay right), category null."""
    if with_total:
        g = _with_total_row(sliced, ["categoria_ia"])
    else:
        g = sliced.groupBy("categoria_ia").agg(distinct_count_blank("id").alias("qtd_licitacoes"), F.sum("quantidade").alias("qtd_itens"),
                                               F.sum("valor").alias("_v"))
    j = _with_total_share(g, unsliced)
    extra = ["linha_total"] if with_total else []
    return j.select("categoria_ia", *_detail_cols(), *extra).orderBy(*(["linha_total"] if with_total else []), "categoria_ia")


def supplier_detail(sliced: DataFrame, unsliced: DataFrame, with_total: bool = False) -> DataFrame:
    """V7 (M16 with ``with_total``): rank, name, tax id, tenders, share, ticket,
    value; value descending.  The rank is dense over the selected (name, tax id)
    pairs; on the total row rank, name and tax id are null."""
    g = materialize(_with_total_share(_with_total_row(sliced, ["nome", "cpfCnpjVencedor"]), unsliced))  # read by every step of the ranks
    j = ordered_stats(g.where("linha_total = 0"), [], "_v")
    rows = j.select(F.col("_dense").cast("bigint").alias("rank"), "nome", "cpfCnpjVencedor", *_detail_cols(), "linha_total").drop("qtd_itens")
    if not with_total:
        return rows.drop("linha_total").orderBy("rank", "nome")
    total = g.where("linha_total = 1").select(F.lit(None).cast("bigint").alias("rank"), "nome", "cpfCnpjVencedor", *_detail_cols(), "linha_total")
    return rows.unionByName(total.drop("qtd_itens")).orderBy("linha_total", "rank", "nome")
