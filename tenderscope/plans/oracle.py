"""DuckDB oracle SQL for every registered query.

Each text runs on DuckDB views named after the driver tables.  The shared
``fact`` CTE mirrors ``sources.tables.fact``; output hygiene matches the Spark
side: money as double rounded to 4 places, ratios to 6, integers as BIGINT.
"""

from __future__ import annotations

FACT_CTE = """
fact AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS id,
         CAST(l.l_partkey AS VARCHAR) AS codigoItemCompra,
         p.p_name AS descricao,
         p.p_name AS descricao_original,
         p.p_type AS categoria_ia,
         CAST(l.l_quantity AS BIGINT) AS quantidade,
         CAST(l.l_extendedprice AS DECIMAL(19,4)) AS valor,
         CAST(l.l_suppkey AS VARCHAR) AS cpfCnpjVencedor,
         s.s_name AS nome,
         CASE WHEN l.l_linenumber % 2 = 0 THEN 'PF' ELSE 'PJ' END AS tipoPessoa,
         p.p_brand AS descUnidadeFornecimento,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS mes
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

# monthly totals on the model calendar spine (Jan of first year .. last month + 7)
SPINE_CTE = """
m AS (SELECT {k}mes, SUM(valor) AS v FROM fact GROUP BY ALL),
b AS (SELECT CAST(date_trunc('year', MIN(mes)) AS DATE) AS d0,
             CAST(MAX(mes) + INTERVAL 7 MONTH AS DATE) AS d1 FROM m),
months AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS mes FROM b),
keys AS (SELECT DISTINCT {kd} FROM m),
grid AS (SELECT {kg}months.mes FROM {kfrom}months),
g AS (SELECT {kgs}grid.mes, year(grid.mes) AS ano, year(grid.mes) * 12 + month(grid.mes) AS mseq, m.v
      FROM grid LEFT JOIN m ON grid.mes = m.mes {kjoin})"""


def spine_cte(keys=()) -> str:
    keys = list(keys)
    if not keys:
        return SPINE_CTE.format(k="", kd="1 AS one", kg="", kfrom="", kgs="", kjoin="")
    return SPINE_CTE.format(
        k="".join(f"{k}, " for k in keys),
        kd=", ".join(keys),
        kg="".join(f"keys.{k}, " for k in keys),
        kfrom="keys, ",
        kgs="".join(f"grid.{k}, " for k in keys),
        kjoin="".join(f" AND grid.{k} IS NOT DISTINCT FROM m.{k}" for k in keys),
    )


def with_fact(body: str, *ctes: str) -> str:
    parts = [FACT_CTE] + [c for c in ctes if c]
    return "WITH " + ",\n".join(p.strip("\n") for p in parts) + "\n" + body


def money(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), 4)"


def ratio(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), 6)"


def bsub(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL ELSE COALESCE({a}, 0) - COALESCE({b}, 0) END)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def dcount_blank(c: str) -> str:
    return f"(COUNT(DISTINCT {c}) + COALESCE(MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0))"


RAW_ITEMS_CTE = """
raw_items AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS id,
         CAST(l.l_partkey AS VARCHAR) AS codigoItemCompra,
         CAST(l.l_linenumber AS VARCHAR) AS numero,
         p.p_name AS descricao,
         CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS quantidade,
         translate(format('{:,.2f}', l.l_extendedprice), ',.', '.,') AS valor,
         CAST(l.l_suppkey AS VARCHAR) AS cpfCnpjVencedor
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

HEADERS_CTE = """
headers AS (
  SELECT strftime(o_orderdate, '%m/%Y') AS "mes/ano", o_orderkey AS id,
         CAST(o_orderdate AS DATE) AS dataAbertura, o_orderstatus AS situacaoCompra,
         o_orderpriority AS modalidadeLicitacao, o_totalprice AS valor
  FROM orders
)"""

MAPA_CTE = """
mapa AS (
  SELECT p_name AS descricao_original, p_type AS categoria_ia,
         ((200 * n + ntot) // (2 * ntot)) / 100.0 AS confianca
  FROM (SELECT p_name, p_type, n, SUM(n) OVER (PARTITION BY p_name) AS ntot,
               ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY n DESC, p_type) AS rn
        FROM (SELECT p_name, p_type, COUNT(*) AS n FROM part GROUP BY ALL) c) r
  WHERE rn = 1
)"""

EXPENSES_CTE = """
expenses AS (
  SELECT 2024 AS ano, CAST(n.n_nationkey AS VARCHAR) AS codigoOrgao, n.n_name AS nomeOrgao,
         CAST(c.c_acctbal AS VARCHAR) AS valor
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip("\n") for c in ctes if c) + "\n" + body
