"""Queries: conversions (P), joins (J), duplicates (A), calendar (C-a…C-g),
month windows (S1) and the multi-year union (S11)."""

from __future__ import annotations

from pyspark.sql import functions as F
from ..operators.util import rnd

from ..functions.parse import parse_br, parse_decimal_comma, parse_loose, parse_month
from ..operators import calendar as cal
from ..operators.dedup import count_duplicates, select_present
from ..operators.filters import cast_columns, with_month
from ..operators.joins import (attach_month, enrich_category, filter_in, reconcile, unmatched,
                               with_calendar)
from ..operators.measures import measures
from ..operators.timeintel import on_spine
from ..operators.util import money
from ..sources.tables import description_map, expenses, fact, headers, raw_items, read_table
from .oracle import (EXPENSES_CTE, FACT_CTE, HEADERS_CTE, MAPA_CTE, RAW_ITEMS_CTE, money as smoney,
                     spine_cte, with_ctes, with_fact)
from .registry import register

_BR = "CAST(replace(replace(valor, '.', ''), ',', '.') AS DOUBLE)"


# ---------------------------------------------------------------- P6–P10, P12

@register("parse_decimal_comma", with_ctes(
    "SELECT id, numero, valor, TRY_CAST(replace(valor, ',', '.') AS DOUBLE) AS valor_num FROM raw_items",
    RAW_ITEMS_CTE))
def q_parse_decimal_comma(spark, d):
    r = raw_items(spark, d)
    return r.select("id", "numero", "valor", parse_decimal_comma("valor").alias("valor_num"))


@register("parse_br_number", with_ctes(
    "SELECT id, numero, valor, TRY_CAST(replace(replace(valor, '.', ''), ',', '.') AS DOUBLE) AS valor_num FROM raw_items",
    RAW_ITEMS_CTE))
def q_parse_br_number(spark, d):
    r = raw_items(spark, d)
    return r.select("id", "numero", "valor", parse_br("valor").alias("valor_num"))


@register("parse_loose_number", with_ctes(
    "SELECT id, numero, valor, TRY_CAST(replace(regexp_replace(valor, '[^0-9,.]', '', 'g'), ',', '.') AS DOUBLE) AS valor_num FROM raw_items",
    RAW_ITEMS_CTE))
def q_parse_loose_number(spark, d):
    r = raw_items(spark, d)
    return r.select("id", "numero", "valor", parse_loose("valor").alias("valor_num"))


@register("parse_month", with_ctes(
    """SELECT id, "mes/ano",
         CASE WHEN regexp_full_match("mes/ano", '[0-9]{2}/[0-9]{4}')
              THEN CAST(try_strptime('01/' || "mes/ano", '%d/%m/%Y') AS DATE) END AS mes
       FROM headers""", HEADERS_CTE))
def q_parse_month(spark, d):
    h = headers(spark, d)
    return h.select("id", "`mes/ano`", parse_month("`mes/ano`").alias("mes"))


@register("cast_fact", with_ctes(
    """SELECT i.id, i.numero,
         TRY_CAST(TRY_CAST(replace(replace(i.valor, '.', ''), ',', '.') AS DOUBLE) AS DECIMAL(19,4)) AS valor,
         CAST(try_strptime('01/' || h."mes/ano", '%d/%m/%Y') AS DATE) AS mes
       FROM raw_items i LEFT JOIN headers h ON i.id = CAST(h.id AS VARCHAR)""",
    RAW_ITEMS_CTE, HEADERS_CTE))
def q_cast_fact(spark, d):
    j = attach_month(raw_items(spark, d), headers(spark, d))
    typed = cast_columns(j.select("id", "numero", parse_br("valor").alias("valor"), parse_month("`mes/ano`").alias("mes")),
                         {"valor": "decimal(19,4)", "mes": "date"})
    return typed


@register("dropna_subset", with_ctes(
    """SELECT h."mes/ano" AS mes_ano, COUNT(*) AS linhas,
         ROUND(SUM(TRY_CAST(replace(i.valor, ',', '.') AS DOUBLE)), 2) AS valor
       FROM raw_items i LEFT JOIN headers h ON i.id = CAST(h.id AS VARCHAR)
       WHERE TRY_CAST(replace(i.valor, ',', '.') AS DOUBLE) IS NOT NULL AND h."mes/ano" IS NOT NULL
       GROUP BY 1""", RAW_ITEMS_CTE, HEADERS_CTE))
def q_dropna_subset(spark, d):
    j = attach_month(raw_items(spark, d), headers(spark, d))
    j = j.select(F.col("`mes/ano`").alias("mes_ano"), parse_decimal_comma("valor").alias("v"))
    j = j.dropna(subset=["mes_ano", "v"])
    return j.groupBy("mes_ano").agg(F.count(F.lit(1)).alias("linhas"), rnd(F.sum("v"), 2).alias("valor"))


@register("select_present", with_ctes("SELECT id, \"mes/ano\", valor FROM headers", HEADERS_CTE))
def q_select_present(spark, d):
    df, missing = select_present(headers(spark, d), ["id", "mes/ano", "valor", "orgaoInexistente"])
    assert missing == ["orgaoInexistente"]
    return df


@register("filter_period", with_fact(
    f"SELECT mes, {smoney('SUM(valor)')} AS valor_total FROM fact WHERE mes >= DATE '1996-01-01' AND mes <= DATE '1997-12-01' GROUP BY mes"))
def q_filter_period(spark, d):
    from ..operators.filters import filter_period
    f = filter_period(fact(spark, d), "1996-01-01", "1997-12-01")
    return f.groupBy("mes").agg(money(F.sum("valor")).alias("valor_total"))


@register("filter_category", with_fact(
    f"SELECT mes, {smoney('SUM(valor)')} AS valor_total FROM fact WHERE categoria_ia = 'PROMO' GROUP BY mes"))
def q_filter_category(spark, d):
    f = fact(spark, d).where(F.col("categoria_ia") == "PROMO")
    return f.groupBy("mes").agg(money(F.sum("valor")).alias("valor_total"))


# ---------------------------------------------------------------- joins

@register("join_items_header", with_ctes(
    """SELECT i.*, h."mes/ano" FROM raw_items i LEFT JOIN headers h ON i.id = CAST(h.id AS VARCHAR)""",
    RAW_ITEMS_CTE, HEADERS_CTE))
def q_join_items_header(spark, d):
    return attach_month(raw_items(spark, d), headers(spark, d))


@register("enrich_category", with_ctes(
    """SELECT i.id, i.numero, i.descricao, m.descricao_original, m.categoria_ia, m.confianca
       FROM raw_items i JOIN mapa m ON i.descricao = m.descricao_original""", RAW_ITEMS_CTE, MAPA_CTE))
def q_enrich_category(spark, d):
    e = enrich_category(raw_items(spark, d), description_map(spark, d))
    return e.select("id", "numero", "descricao", "descricao_original", "categoria_ia", "confianca")


@register("join_reconcile", with_ctes(
    f"""SELECT b.*, a.* FROM
       (SELECT COUNT(*) AS linhas_antes, COUNT(DISTINCT id) AS ids_antes,
               {smoney('SUM(CAST(l_extendedprice AS DECIMAL(19,4)))')} AS valor_antes
        FROM (SELECT CAST(l_orderkey AS VARCHAR) AS id, l_extendedprice FROM lineitem) x) b,
       (SELECT COUNT(*) AS linhas_depois, COUNT(DISTINCT id) AS ids_depois,
               {smoney('SUM(valor)')} AS valor_depois FROM fact) a""", FACT_CTE))
def q_join_reconcile(spark, d):
    li = read_table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"), F.col("l_extendedprice").cast("decimal(19,4)").alias("valor"))
    return reconcile(li, fact(spark, d))


@register("map_reconcile", with_ctes(
    """SELECT b.*, a.* FROM
       (SELECT COUNT(*) AS linhas_antes, COUNT(DISTINCT id) AS ids_antes, ROUND(CAST(SUM(v) AS DOUBLE), 4) AS valor_antes FROM it) b,
       (SELECT COUNT(*) AS linhas_depois, COUNT(DISTINCT id) AS ids_depois, ROUND(CAST(SUM(v) AS DOUBLE), 4) AS valor_depois
        FROM it JOIN mapa m ON it.descricao = m.descricao_original) a""",
    RAW_ITEMS_CTE, MAPA_CTE,
    "it AS (SELECT id, descricao, TRY_CAST(replace(replace(valor, '.', ''), ',', '.') AS DECIMAL(19,4)) AS v FROM raw_items)"))
def q_map_reconcile(spark, d):
    """Item rows, ids and value before and after the join to the map."""
    it = raw_items(spark, d).select("id", "descricao", parse_br("valor").try_cast("decimal(19,4)").alias("valor"))
    return reconcile(it, enrich_category(it, description_map(spark, d)))


@register("month_label", with_ctes(
    """SELECT "mes/ano", COUNT(*) AS linhas, ROUND(CAST(SUM(valor) AS DOUBLE), 2) AS valor FROM headers GROUP BY 1""", HEADERS_CTE))
def q_month_label(spark, d):
    """The pull's month label on every header."""
    pull = with_month(headers(spark, d).drop("mes/ano"), F.date_format("dataAbertura", "MM/yyyy"))
    return pull.groupBy("mes/ano").agg(F.count(F.lit(1)).alias("linhas"), rnd(F.sum("valor"), 2).alias("valor"))


@register("join_unmatched", with_ctes(
    """SELECT i.id, i.numero, i.descricao FROM raw_items i
       WHERE NOT EXISTS (SELECT 1 FROM mapa m WHERE m.descricao_original = i.descricao AND m.confianca >= 0.3)""",
    RAW_ITEMS_CTE, MAPA_CTE))
def q_join_unmatched(spark, d):
    # rows that an inner join with the confident part of the map would lose
    m = description_map(spark, d).where(F.col("confianca") >= 0.3)
    return unmatched(raw_items(spark, d), m).select("id", "numero", "descricao")


@register("star_calendar", with_ctes(
    f"""SELECT year(mes) AS Ano, month(mes) AS MesNum, year(mes) * 100 + month(mes) AS MesAnoNumero,
          {smoney('SUM(valor)')} AS valor_total, COUNT(*) AS qtd_linhas
        FROM fact GROUP BY ALL""", FACT_CTE))
def q_star_calendar(spark, d):
    f = fact(spark, d)
    j = with_calendar(f, cal.calendar(f))
    return j.groupBy("Ano", "MesNum", "MesAnoNumero").agg(
        money(F.sum("valor")).alias("valor_total"), F.count(F.lit(1)).alias("qtd_linhas")
    ).select(F.col("Ano").cast("bigint").alias("Ano"), F.col("MesNum").cast("bigint").alias("MesNum"),
             F.col("MesAnoNumero").cast("bigint").alias("MesAnoNumero"), "valor_total", "qtd_linhas")


@register("monthly_spine", with_fact(
    f"SELECT categoria_ia, mes, CAST(ano AS BIGINT) AS ano, {smoney('v')} AS valor_total FROM g",
    spine_cte(["categoria_ia"])))
def q_monthly_spine(spark, d):
    g = on_spine(fact(spark, d), ["categoria_ia"])
    return g.select("categoria_ia", "mes", F.col("ano").cast("bigint").alias("ano"), money("v").alias("valor_total"))


@register("filter_in_top_names", with_ctes(
    f"""SELECT f.descricao, {smoney('SUM(f.valor)')} AS valor_total FROM fact f
        WHERE f.descricao IN (SELECT descricao_original FROM mapa WHERE confianca >= 0.3)
        GROUP BY 1""", FACT_CTE, MAPA_CTE))
def q_filter_in(spark, d):
    keys = description_map(spark, d).where(F.col("confianca") >= 0.3).select(F.col("descricao_original").alias("descricao"))
    f = filter_in(fact(spark, d), keys, ["descricao"])
    return f.groupBy("descricao").agg(money(F.sum("valor")).alias("valor_total"))


# ---------------------------------------------------------------- duplicates

@register("dup_count_atomic", "SELECT CAST(COUNT(*) - COUNT(DISTINCT (o_orderkey, o_orderdate, o_orderstatus, o_orderpriority, o_totalprice)) AS BIGINT) AS duplicados FROM orders")
def q_dup_count_atomic(spark, d):
    # headers carry a nested map column that is skipped
    return count_duplicates(headers(spark, d), atomic_only=True)


@register("dup_count_all", with_ctes(
    "SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicados FROM (SELECT COUNT(*) AS n FROM raw_items GROUP BY id, codigoItemCompra, descricao, quantidade, valor, cpfCnpjVencedor) g",
    RAW_ITEMS_CTE))
def q_dup_count_all(spark, d):
    r = raw_items(spark, d).drop("numero")
    return count_duplicates(r, atomic_only=False)


@register("distinct_ids", "SELECT DISTINCT o_orderkey AS id FROM orders")
def q_distinct_ids(spark, d):
    return headers(spark, d).select("id").distinct()


@register("distinct_descriptions", with_fact("SELECT DISTINCT descricao FROM fact"))
def q_distinct_descriptions(spark, d):
    return fact(spark, d).select("descricao").distinct()


@register("drop_duplicates", with_ctes(
    "SELECT DISTINCT id, codigoItemCompra, descricao, quantidade, valor, cpfCnpjVencedor FROM raw_items", RAW_ITEMS_CTE))
def q_drop_duplicates(spark, d):
    return raw_items(spark, d).drop("numero").dropDuplicates()


@register("header_count_by_year", "SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, COUNT(*) AS linhas FROM orders GROUP BY 1")
def q_header_count(spark, d):
    h = headers(spark, d)
    return h.groupBy(F.year("dataAbertura").cast("bigint").alias("ano")).agg(F.count(F.lit(1)).alias("linhas"))


# ---------------------------------------------------------------- calendar

_CAL_SQL = """
SELECT CAST(d AS DATE) AS Date, CAST(year(d) AS BIGINT) AS Ano, CAST(month(d) AS BIGINT) AS Mes,
  (['janeiro','fevereiro','março','abril','maio','junho','julho','agosto','setembro','outubro','novembro','dezembro'])[month(d)] AS NomeMes,
  (['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'])[month(d)] AS NomeMesAbrev,
  (['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'])[month(d)] || '/' || CAST(year(d) AS VARCHAR) AS MesAno,
  CAST(year(d) * 100 + month(d) AS BIGINT) AS MesAnoNumero,
  'T' || CAST(quarter(d) AS VARCHAR) AS Trimestre,
  CAST(year(d) AS VARCHAR) || ' T' || CAST(quarter(d) AS VARCHAR) AS AnoTrimestre,
  CAST(date_trunc('month', d) AS DATE) AS InicioMes,
  CAST(last_day(d) AS DATE) AS FimMes,
  (['domingo','segunda-feira','terça-feira','quarta-feira','quinta-feira','sexta-feira','sábado'])[dayofweek(d) + 1] AS DiaSemana,
  'Qtr ' || CAST(quarter(d) AS VARCHAR) AS QuarterLabel,
  CAST((month(d) + 2) // 3 AS BIGINT) AS QuarterNo,
  CAST(day(d) AS BIGINT) AS Dia
FROM (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS d FROM b) days"""


def _cal_out(c):
    return c.select(
        "Date", *[F.col(x).cast("bigint").alias(x) for x in ["Ano", "Mes"]],
        "NomeMes", "NomeMesAbrev", "MesAno", F.col("MesAnoNumero").cast("bigint").alias("MesAnoNumero"),
        "Trimestre", "AnoTrimestre", "InicioMes", "FimMes", "DiaSemana", "QuarterLabel",
        F.col("QuarterNo").cast("bigint").alias("QuarterNo"), F.col("Dia").cast("bigint").alias("Dia"))


@register("calendar", with_fact(_CAL_SQL,
    "b AS (SELECT CAST(date_trunc('year', MIN(mes)) AS DATE) AS d0, CAST(MAX(mes) + INTERVAL 7 MONTH AS DATE) AS d1 FROM fact)"))
def q_calendar(spark, d):
    return _cal_out(cal.calendar(fact(spark, d), end="edate7"))


@register("calendar_full_years", with_fact(_CAL_SQL,
    "b AS (SELECT CAST(date_trunc('year', MIN(mes)) AS DATE) AS d0, make_date(year(MAX(mes)), 12, 31) AS d1 FROM fact)"))
def q_calendar_full_years(spark, d):
    return _cal_out(cal.calendar(fact(spark, d), end="year"))


@register("date_hierarchy_rollup", with_fact(
    f"""SELECT CAST(year(mes) AS BIGINT) AS Ano, CAST(quarter(mes) AS BIGINT) AS QuarterNo, CAST(month(mes) AS BIGINT) AS Mes,
          {smoney('SUM(valor)')} AS valor_total
        FROM fact GROUP BY ROLLUP (year(mes), quarter(mes), month(mes))"""))
def q_date_hierarchy_rollup(spark, d):
    f = fact(spark, d).select(F.year("mes").cast("bigint").alias("Ano"), F.quarter("mes").cast("bigint").alias("QuarterNo"),
                              F.month("mes").cast("bigint").alias("Mes"), "valor")
    return f.rollup("Ano", "QuarterNo", "Mes").agg(money(F.sum("valor")).alias("valor_total"))


@register("month_windows", with_fact(
    """SELECT strftime(d, '%d/%m/%Y') AS data_inicial, strftime(last_day(d), '%d/%m/%Y') AS data_final,
          strftime(d, '%m/%Y') AS mes_ano
       FROM (SELECT unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 1), INTERVAL 1 MONTH)) AS d
             FROM (SELECT year(MIN(mes)) AS y0, year(MAX(mes)) AS y1 FROM fact) y) x"""))
def q_month_windows(spark, d):
    y = fact(spark, d).agg(F.year(F.min("mes")).alias("y0"), F.year(F.max("mes")).alias("y1"))
    return cal.month_windows_from(y)


@register("union_years", with_fact(
    f"""SELECT CAST(year(mes) AS BIGINT) AS ano, COUNT(*) AS linhas, COUNT(tipoPessoa) AS com_tipo,
          {smoney('SUM(valor)')} AS valor_total
        FROM (SELECT id, valor, mes, NULL AS tipoPessoa FROM fact WHERE year(mes) < 1998
              UNION ALL SELECT id, valor, mes, tipoPessoa FROM fact WHERE year(mes) >= 1998) u
        GROUP BY 1"""))
def q_union_years(spark, d):
    from ..sources.files import union_years
    f = fact(spark, d)
    old = f.where(F.year("mes") < 1998).select("id", "valor", "mes")
    new = f.where(F.year("mes") >= 1998).select("id", "valor", "mes", "tipoPessoa")
    u = union_years([old, new])
    return u.groupBy(F.year("mes").cast("bigint").alias("ano")).agg(
        F.count(F.lit(1)).alias("linhas"), F.count("tipoPessoa").alias("com_tipo"), money(F.sum("valor")).alias("valor_total"))


@register("star_map", with_ctes(
    f"""SELECT m.confianca, COUNT(*) AS qtd_linhas, {smoney('SUM(f.valor)')} AS valor_total
        FROM fact f LEFT JOIN mapa m ON f.descricao_original = m.descricao_original GROUP BY 1""", FACT_CTE, MAPA_CTE))
def q_star_map(spark, d):
    """Fact → description map (left star join), value by map confidence."""
    from ..operators.joins import with_map
    j = with_map(fact(spark, d), description_map(spark, d))
    return j.groupBy("confianca").agg(F.count(F.lit(1)).alias("qtd_linhas"), money(F.sum("valor")).alias("valor_total"))


@register("distinct_categories", with_fact("SELECT DISTINCT categoria_ia FROM fact"))
def q_distinct_categories(spark, d):
    """Every category at once (null kept as a value)."""
    return fact(spark, d).select("categoria_ia").distinct()
