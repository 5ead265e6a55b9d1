"""Queries on inputs where the rules show: repeated rows (A), small numbers as
text (P6, P8, M15), uncategorised rows (D1, D2), rows chosen by the map (J7),
records without a schema (S6), layers by year (S8, S9, S11), unsliced shares (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parse import parse_br, parse_decimal_comma, parse_loose
from ..operators import quality as dq
from ..operators import shares as sh
from ..operators.dedup import count_duplicates
from ..operators.joins import filter_by_map
from ..operators.util import money, rnd
from ..sources.files import read_json_inferred, read_years, write_years
from ..sources.tables import description_map, fact, read_table
from . import medallion as md
from .oracle import FACT_CTE, MAPA_CTE, div, money as smoney, ratio as sratio, with_ctes, with_fact
from .registry import register

# ---------------------------------------------------------------- repeated rows: who sold what, how much of it

_SALES = """sales AS (SELECT CAST(l_partkey AS VARCHAR) AS codigoItemCompra, CAST(l_quantity AS BIGINT) AS quantidade,
                 strftime(l_shipdate, '%Y') AS ano FROM lineitem)"""


def _sales(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").cast("string").alias("codigoItemCompra"), F.col("l_quantity").cast("bigint").alias("quantidade"),
                     F.date_format("l_shipdate", "yyyy").alias("ano"))


@register("dup_count_sales", with_ctes(
    "SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicados FROM (SELECT COUNT(*) AS n FROM sales GROUP BY codigoItemCompra, quantidade, ano) g", _SALES))
def q_dup_count_sales(spark, d):
    """A2: all columns."""
    return count_duplicates(_sales(spark, d), atomic_only=False)


@register("dup_count_nested", with_ctes(
    "SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicados FROM (SELECT COUNT(*) AS n FROM sales GROUP BY codigoItemCompra, quantidade, ano) g", _SALES))
def q_dup_count_nested(spark, d):
    """A1: a nested column that differs is left out."""
    s = _sales(spark, d).withColumn("origem", F.struct(F.monotonically_increasing_id().alias("linha")))
    return count_duplicates(s, atomic_only=True)


@register("drop_duplicates_sales", with_ctes("SELECT DISTINCT codigoItemCompra, quantidade, ano FROM sales", _SALES))
def q_drop_duplicates_sales(spark, d):
    return _sales(spark, d).dropDuplicates()


# ---------------------------------------------------------------- small numbers as text

_RATES = """rates AS (SELECT CAST(l.l_orderkey AS VARCHAR) AS id, CAST(l.l_linenumber AS BIGINT) AS numero, p.p_type AS categoria_ia,
                 CAST(date_trunc('month', l.l_shipdate) AS DATE) AS mes,
                 (CASE WHEN l.l_linenumber % 3 = 0 THEN '-' ELSE '' END) || replace(printf('%.2f', l.l_discount * 100), '.', ',')
                   || (CASE WHEN l.l_linenumber % 4 = 0 THEN ' %' ELSE '' END) AS taxa
          FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def _rates(spark, d):
    li, part = read_table(spark, d, "lineitem"), read_table(spark, d, "part")
    sign = F.when(F.col("l_linenumber") % 3 == 0, "-").otherwise("")
    unit = F.when(F.col("l_linenumber") % 4 == 0, " %").otherwise("")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").cast("long").alias("numero"), F.col("p_type").alias("categoria_ia"),
        F.trunc("l_shipdate", "MM").alias("mes"), F.concat(sign, F.translate(F.format_string("%.2f", F.col("l_discount") * 100), ".", ","), unit).alias("taxa"))


@register("parse_rates", with_ctes(
    """SELECT id, numero, taxa, TRY_CAST(replace(taxa, ',', '.') AS DOUBLE) AS decimal, TRY_CAST(replace(replace(taxa, '.', ''), ',', '.') AS DOUBLE) AS br,
         TRY_CAST(replace(regexp_replace(taxa, '[^0-9,.]', '', 'g'), ',', '.') AS DOUBLE) AS solto FROM rates""", _RATES))
def q_parse_rates(spark, d):
    """P6, P7, P8 side by side on signed percentages with and without a unit."""
    return _rates(spark, d).select("id", "numero", "taxa", parse_decimal_comma("taxa").alias("decimal"), parse_br("taxa").alias("br"), parse_loose("taxa").alias("solto"))


@register("category_rate_series", with_ctes(
    """SELECT categoria_ia, mes, ROUND(COALESCE(SUM(TRY_CAST(replace(regexp_replace(taxa, '[^0-9,.]', '', 'g'), ',', '.') AS DOUBLE)), 0), 2) AS total
       FROM rates GROUP BY ALL""", _RATES))
def q_category_rate_series(spark, d):
    """M15 over values the loose parser reads."""
    return _rates(spark, d).groupBy("categoria_ia", "mes").agg(rnd(F.coalesce(F.sum(parse_loose("taxa")), F.lit(0.0)), 2).alias("total"))


# ---------------------------------------------------------------- the map decides

#: confidence below which the test map leaves a description without a category
CUT = 0.25
_MAPPED = f"""mapped AS (SELECT f.mes, CASE WHEN m.confianca >= {CUT} THEN m.categoria_ia WHEN m.confianca IS NULL THEN NULL
                  ELSE 'Outros / Necessita Revisão' END AS categoria_ia
          FROM fact f LEFT JOIN mapa m ON f.descricao_original = m.descricao_original)"""


def _mapped(spark, d):
    m = description_map(spark, d).select("descricao_original", F.col("categoria_ia").alias("_cat"), "confianca")
    j = fact(spark, d).select("descricao_original", "mes").join(m, "descricao_original", "left")
    return j.select("mes", F.when(F.col("confianca") >= CUT, F.col("_cat")).when(F.col("confianca").isNotNull(), F.lit(dq.NEEDS_REVIEW)).alias("categoria_ia"))


_BAD = "(categoria_ia IS NULL OR categoria_ia IN ('Sem Descrição', 'Outros / Necessita Revisão'))"


@register("uncategorised_by_month", with_ctes(
    f"""SELECT mes, COUNT(*) AS qtd_linhas, COUNT(*) FILTER (WHERE {_BAD}) AS qtd_sem_categoria,
          {sratio(f"1 - COALESCE({div(f'COUNT(*) FILTER (WHERE {_BAD})', 'COUNT(*)')}, 0)")} AS pct_bem_categorizados
        FROM mapped GROUP BY 1""", FACT_CTE, MAPA_CTE, _MAPPED))
def q_uncategorised_by_month(spark, d):
    """D1, D2 where the map left rows without a category."""
    return dq.uncategorised(_mapped(spark, d), ["mes"])


@register("uncategorised_by_category", with_ctes(
    f"""SELECT categoria_ia, COUNT(*) AS qtd_linhas, (SELECT COUNT(*) FROM mapped WHERE {_BAD}) AS qtd_sem_categoria,
          {sratio(f"1 - COALESCE({div(f'(SELECT COUNT(*) FROM mapped WHERE {_BAD})', 'COUNT(*)')}, 0)")} AS pct_bem_categorizados
        FROM mapped GROUP BY 1""", FACT_CTE, MAPA_CTE, _MAPPED))
def q_uncategorised_by_category(spark, d):
    return dq.uncategorised(_mapped(spark, d), ["categoria_ia"])


@register("items_below_confidence", with_ctes(
    f"""SELECT categoria_ia, COUNT(*) AS qtd_linhas, {smoney('SUM(valor)')} AS valor_total FROM fact
        WHERE descricao_original IN (SELECT descricao_original FROM mapa WHERE confianca < {CUT}) GROUP BY 1""", FACT_CTE, MAPA_CTE))
def q_items_below_confidence(spark, d):
    """Fact rows by a property of their description in the map."""
    f = filter_by_map(fact(spark, d), description_map(spark, d), F.col("confianca") < CUT)
    return f.groupBy("categoria_ia").agg(F.count(F.lit(1)).alias("qtd_linhas"), money(F.sum("valor")).alias("valor_total"))


# ---------------------------------------------------------------- shares without slicers


@register("share_of_total_all", with_fact(
    f"""SELECT nome, {smoney('SUM(valor)')} AS valor_total, {sratio(div('SUM(valor)', '(SELECT SUM(valor) FROM fact)'))} AS pct_total FROM fact GROUP BY 1"""))
def q_share_of_total_all(spark, d):
    f = fact(spark, d)
    return sh.share_of_total(f, f, ["nome"])


@register("share_of_category_all", with_fact(
    f"""SELECT s.categoria_ia, s.mes, {smoney('SUM(s.valor)')} AS valor_total, {sratio(div('SUM(s.valor)', 'ANY_VALUE(t.tv)'))} AS pct_categoria
        FROM fact s JOIN (SELECT categoria_ia, SUM(valor) AS tv FROM fact GROUP BY 1) t ON s.categoria_ia = t.categoria_ia GROUP BY 1, 2"""))
def q_share_of_category_all(spark, d):
    f = fact(spark, d)
    return sh.share_of_category(f, f, ["categoria_ia", "mes"])


# ---------------------------------------------------------------- records without a schema, layers by year


@register("json_inferred", """
    SELECT CASE WHEN NOT ruim THEN id END AS id, CASE WHEN NOT ruim THEN situacao END AS situacao, CASE WHEN NOT ruim AND situacao <> 'O' THEN prioridade END AS prioridade,
           CASE WHEN NOT ruim THEN CASE WHEN situacao = 'P' THEN 'R$ ' || centavos ELSE CAST(centavos AS VARCHAR) END END AS valor, ruim AS corrompida
    FROM (SELECT o_orderkey AS id, o_orderstatus AS situacao, o_orderpriority AS prioridade, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS centavos,
                 o_orderkey % 97 = 0 AS ruim FROM orders) x""")
def q_json_inferred(spark, d):
    """S6 by inference: nested cells, a field some records lack, one of two types, and cut-off lines."""
    o = read_table(spark, d, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    record = lambda value, cell: F.to_json(F.struct(F.col("o_orderkey").alias("id"), cell.alias("licitacao"), value.alias("valor")))
    whole = F.struct(F.col("o_orderstatus").alias("situacao"), F.col("o_orderpriority").alias("prioridade"))
    line = F.when(F.col("o_orderstatus") == "P", record(F.concat(F.lit("R$ "), cents.cast("string")), whole)) \
            .when(F.col("o_orderstatus") == "O", record(cents, F.struct(F.col("o_orderstatus").alias("situacao")))).otherwise(record(cents, whole))
    path = md.scratch_path(spark, "records", d)
    o.select(F.when(F.col("o_orderkey") % 97 == 0, F.expr("'{\"id\": ' || o_orderkey || ', \"licit'")).otherwise(line).alias("value")).write.mode("overwrite").text(path)
    r = read_json_inferred(spark, path)
    return r.select("id", "licitacao.situacao", "licitacao.prioridade", "valor", F.col("_corrupt_record").isNotNull().alias("corrompida"))


@register("yearly_layer", """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, COUNT(*) AS linhas, COUNT(*) FILTER (WHERE year(o_orderdate) = 1997) AS com_modalidade,
           ROUND(CAST(SUM(o_totalprice) AS DOUBLE), 2) AS valor FROM orders GROUP BY 1""")
def q_yearly_layer(spark, d):
    """All years stored, then one rewritten with a new column, then all read together."""
    o = read_table(spark, d, "orders").withColumn("ano", F.year("o_orderdate").cast("bigint"))
    path = md.scratch_path(spark, "anos", d)
    write_years(o.select("ano", "o_orderkey", "o_totalprice"), path)
    write_years(o.where("ano = 1997").select("ano", "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("modalidade")), path)
    return read_years(spark, path).groupBy(F.col("ano").cast("bigint").alias("ano")).agg(
        F.count(F.lit(1)).alias("linhas"), F.count("modalidade").alias("com_modalidade"), rnd(F.sum("o_totalprice").cast("double"), 2).alias("valor"))
