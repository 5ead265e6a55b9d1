"""Queries: base measures (M), time intelligence (T)."""

from __future__ import annotations

from ..operators.measures import measures
from ..operators.timeintel import time_intelligence, yoy_yearly
from ..sources.tables import fact
from .oracle import bsub, dcount_blank, div, money, ratio, spine_cte, with_fact
from .registry import register

_BASE_SQL = f"""{money('SUM(valor)')} AS valor_total,
  CAST(SUM(quantidade) AS BIGINT) AS qtd_itens,
  {dcount_blank('id')} AS qtd_licitacoes,
  {dcount_blank('cpfCnpjVencedor')} AS qtd_fornecedores,
  {dcount_blank('categoria_ia')} AS qtd_categorias,
  COUNT(*) AS qtd_linhas,
  {ratio(div('SUM(valor)', dcount_blank('id')))} AS ticket_medio,
  {ratio(div('SUM(valor)', 'SUM(quantidade)'))} AS valor_medio_item,
  {ratio(div('SUM(quantidade)', dcount_blank('id')))} AS itens_por_licitacao,
  {money('quantile_cont(CAST(valor AS DOUBLE), 0.5)')} AS valor_mediano_item"""


@register("base_measures_total", with_fact(f"SELECT {_BASE_SQL} FROM fact"))
def base_measures_total(spark, d):
    return measures(fact(spark, d))


@register("base_measures_by_category", with_fact(f"SELECT categoria_ia, {_BASE_SQL} FROM fact GROUP BY categoria_ia"))
def base_measures_by_category(spark, d):
    return measures(fact(spark, d), by=["categoria_ia"])


@register("base_measures_by_month", with_fact(f"SELECT mes, {_BASE_SQL} FROM fact GROUP BY mes"))
def base_measures_by_month(spark, d):
    return measures(fact(spark, d), by=["mes"])


@register("median_item_value", with_fact(
    f"SELECT year(mes) AS ano, {money('quantile_cont(CAST(valor AS DOUBLE), 0.5)')} AS valor_mediano_item FROM fact GROUP BY 1"))
def median_item_value(spark, d):
    from pyspark.sql import functions as F
    f = fact(spark, d).withColumn("ano", F.year("mes").cast("bigint"))
    return measures(f, by=["ano"], names=["valor_mediano_item"])


def _ti_sql(keys=(), cols=None):
    k = "".join(f"{x}, " for x in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    body = f"""
, t AS (SELECT {k}mes, ano, mseq, v,
          LAG(v, 12) OVER (w) AS py,
          LAG(v, 1) OVER (w) AS pm,
          SUM(v) OVER (PARTITION BY {k}ano ORDER BY mseq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd,
          SUM(v) OVER ({part}ORDER BY mseq RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS r12
        FROM g WINDOW w AS ({part}ORDER BY mseq)),
t2 AS (SELECT *, LAG(ytd, 12) OVER ({part}ORDER BY mseq) AS pytd FROM t)
SELECT {k}mes, CAST(ano AS BIGINT) AS ano,
  {money('v')} AS valor_total,
  {money('py')} AS valor_ano_anterior,
  {money(bsub('v', 'py'))} AS delta_yoy,
  {ratio(div(bsub('v', 'py'), 'py'))} AS yoy_pct,
  {money('pm')} AS valor_mes_anterior,
  {money(bsub('v', 'pm'))} AS delta_mom,
  {ratio(div(bsub('v', 'pm'), 'pm'))} AS mom_pct,
  {money('ytd')} AS valor_ytd,
  {money('pytd')} AS valor_ytd_ano_anterior,
  {money('r12')} AS valor_12m
FROM t2"""
    ctes, final = body.split("\nSELECT ", 1)
    final = "SELECT " + final
    if cols:
        sel = ", ".join([*keys, "mes", "ano", *cols])
        final = f"SELECT {sel} FROM ({final}) full_ti"
    sql = with_fact("", spine_cte(keys)).rstrip("\n") + ctes + "\n" + final
    return sql


_YOY = ["valor_total", "valor_ano_anterior", "delta_yoy", "yoy_pct"]
_MOM = ["valor_total", "valor_mes_anterior", "delta_mom", "mom_pct"]


def _ti(spark, d, keys=(), cols=None):
    t = time_intelligence(fact(spark, d), keys)
    return t.select(*keys, "mes", "ano", *cols) if cols else t


@register("yoy_monthly", _ti_sql((), _YOY))
def yoy_monthly(spark, d):
    return _ti(spark, d, (), _YOY)


@register("mom_monthly", _ti_sql((), _MOM))
def mom_monthly(spark, d):
    return _ti(spark, d, (), _MOM)


@register("ytd", _ti_sql((), ["valor_total", "valor_ytd"]))
def ytd(spark, d):
    return _ti(spark, d, (), ["valor_total", "valor_ytd"])


@register("ytd_prior_year", _ti_sql((), ["valor_ytd", "valor_ytd_ano_anterior"]))
def ytd_prior_year(spark, d):
    return _ti(spark, d, (), ["valor_ytd", "valor_ytd_ano_anterior"])


@register("rolling_12m", _ti_sql((), ["valor_total", "valor_12m"]))
def rolling_12m(spark, d):
    return _ti(spark, d, (), ["valor_total", "valor_12m"])


@register("yoy_by_category", _ti_sql(["categoria_ia"], _YOY))
def yoy_by_category(spark, d):
    return _ti(spark, d, ["categoria_ia"], _YOY)


@register("time_intelligence_by_category", _ti_sql(["categoria_ia"]))
def time_intelligence_by_category(spark, d):
    return _ti(spark, d, ["categoria_ia"])


def _yoy_yearly_sql(keys=()):
    k = "".join(f"{x}, " for x in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    body = f"""
, t AS (SELECT {k}ano, v, LAG(v, 12) OVER ({part}ORDER BY mseq) AS py FROM g),
y AS (SELECT {k}ano, SUM(v) AS v, SUM(py) AS py FROM t GROUP BY ALL)
SELECT {k}CAST(ano AS BIGINT) AS ano, {money('v')} AS valor_total, {money('py')} AS valor_ano_anterior,
  {money(bsub('v', 'py'))} AS delta_yoy, {ratio(div(bsub('v', 'py'), 'py'))} AS yoy_pct
FROM y"""
    return with_fact("", spine_cte(keys)).rstrip("\n") + body


@register("yoy_yearly", _yoy_yearly_sql())
def yoy_yearly_q(spark, d):
    return yoy_yearly(fact(spark, d))


@register("yoy_yearly_by_category", _yoy_yearly_sql(["categoria_ia"]))
def yoy_yearly_by_category(spark, d):
    return yoy_yearly(fact(spark, d), ["categoria_ia"])
