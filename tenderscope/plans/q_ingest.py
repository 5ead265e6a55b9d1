"""Queries: paged ingest (S2, S3), files (S6, S7), medallion."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from ..operators.util import rnd

from ..sources.files import read_csv, read_json_records, save_table, write_csv
from ..sources.tables import expenses, headers
from . import medallion as md
from .oracle import EXPENSES_CTE, HEADERS_CTE, with_ctes
from .registry import register

_HDR_PAGED = """hp AS (SELECT o_orderstatus AS org, strftime(o_orderdate, '%m/%Y') AS "mes/ano", o_orderkey AS id,
             o_totalprice AS valor, o_orderpriority AS modalidade FROM orders)"""


@register("paged_headers", with_ctes("SELECT * FROM hp", _HDR_PAGED))
def q_paged_headers(spark, d):
    return md.paged_headers(spark, d)


@register("paged_headers_unit", with_ctes("SELECT * FROM hp WHERE org = 'F' AND \"mes/ano\" LIKE '%/1997'", _HDR_PAGED))
def q_paged_headers_unit(spark, d):
    """S2 for one unit and year: only its folders are read."""
    from ..sources.pages import assemble_pages
    pages = md.landing_zone(spark, d, "headers").where("unidade = 'F' AND lote BETWEEN 199701 AND 199712")
    return assemble_pages(pages, ["unidade", "mes/ano"], md.HEADER_RECORD).withColumnRenamed("unidade", "org")


@register("landed_files", """SELECT o_orderstatus AS unidade, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS lote,
       COUNT(*) AS registros, TRUE AS com_arquivo FROM orders GROUP BY ALL""")
def q_landed_files(spark, d):
    """What each landing folder holds: records on its pages, and that every page names its file."""
    pages = md.landing_zone(spark, d, "headers")
    return pages.groupBy("unidade", F.col("lote").cast("bigint").alias("lote")).agg(
        F.sum(F.json_array_length("body")).cast("bigint").alias("registros"), F.bool_and(F.col("arquivo") != "").alias("com_arquivo"))


_ITEM_PAGED = """ip AS (SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS numero, CAST(l_partkey AS VARCHAR) AS codigoItemCompra,
             CAST(l_quantity AS BIGINT) AS quantidade,
             translate(format('{:,.2f}', l_extendedprice), ',.', '.,') AS valor,
             CAST(l_suppkey AS VARCHAR) AS cpfCnpjVencedor FROM lineitem)"""


@register("paged_items", with_ctes("SELECT * FROM ip", _ITEM_PAGED))
def q_paged_items(spark, d):
    items, _ = md.paged_items(spark, d)
    return items


_ITEM_PAGES = """
r AS (SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS numero, CAST(l_partkey AS VARCHAR) AS codigoItemCompra,
             CAST(l_quantity AS BIGINT) AS quantidade,
             translate(format('{:,.2f}', l_extendedprice), ',.', '.,') AS valor,
             CAST(l_suppkey AS VARCHAR) AS cpfCnpjVencedor FROM lineitem),
c AS (SELECT id, CAST(ceil(COUNT(*) / 3.0) AS BIGINT) AS np FROM r GROUP BY id),
p AS (SELECT r.*, 1 + r.numero % c.np AS page_no FROM r JOIN c USING (id)),
bad AS (SELECT DISTINCT id FROM p WHERE (id + page_no) % 17 = 0)"""


@register("paged_failed_ids", with_ctes("SELECT id FROM bad", _ITEM_PAGES))
def q_paged_failed_ids(spark, d):
    """S3: ids with a failed request in the first pull (the one before the complete pull that ``paged_items`` reads), written as a table."""
    from ..sources.files import read_layer, write_layer
    _, failed = md.first_pull(spark, d)
    path = md.scratch_path(spark, "failed-ids", d)
    write_layer(failed, path)
    return read_layer(spark, path)


@register("items_pipeline", with_ctes(
    """SELECT DISTINCT CAST(i.id AS VARCHAR) AS id, i.numero, i.codigoItemCompra, i.quantidade, i.valor, i.cpfCnpjVencedor, hp."mes/ano"
       FROM ip i LEFT JOIN hp ON i.id = hp.id""", _ITEM_PAGED, _HDR_PAGED))
def q_items_pipeline(spark, d):
    return md.items_pipeline(spark, d)


@register("streamed_headers", with_ctes("SELECT * FROM hp", _HDR_PAGED))
def q_streamed_headers(spark, d):
    """S2 by Structured Streaming: the landed files taken up in micro-batches, the records assembled over all of them."""
    from ..sources.tables import storage_root
    from ..streaming import assembled, start_page_ingest
    landed = md.landing_zone(spark, d, "headers").select("unidade", "lote", "`mes/ano`", "page_no", "status", "body")
    base = f"{storage_root(spark)}/scratch/{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex[:12]}"
    landed.repartition(4).write.json(f"{base}/landing")
    query = start_page_ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/state", max_files_per_trigger=2,
                              schema="unidade STRING, lote INT, `mes/ano` STRING, page_no INT, status INT, body STRING")
    query.awaitTermination()
    return assembled(spark, f"{base}/bronze", md.HEADER_RECORD, ("unidade", "mes/ano")).withColumnRenamed("unidade", "org")


# ---------------------------------------------------------------- files

@register("json_records", with_ctes(
    """SELECT "mes/ano", id, situacaoCompra AS situacao, dataAbertura, valor FROM headers""", HEADERS_CTE))
def q_json_records(spark, d):
    """Header records written as JSON lines (nested status), read back with a schema."""
    path = md.scratch_path(spark, "json", d)
    headers(spark, d).select("`mes/ano`", "id", "licitacao", "dataAbertura", "valor").write.mode("overwrite").json(path)
    r = read_json_records(spark, path, "`mes/ano` STRING, id BIGINT, licitacao STRUCT<situacao: STRING, prioridade: STRING>,"
                                       " dataAbertura DATE, valor DOUBLE")
    return r.select("`mes/ano`", "id", F.col("licitacao.situacao").alias("situacao"), "dataAbertura", "valor")


@register("catalog_table", with_ctes(
    """SELECT nome_orgao, COUNT(*) AS linhas, ROUND(SUM(valor_limpo), 2) AS total_gasto FROM (
         SELECT nomeOrgao AS nome_orgao, TRY_CAST(replace(valor, ',', '.') AS DOUBLE) AS valor_limpo FROM expenses) s GROUP BY 1""", EXPENSES_CTE))
def q_catalog_table(spark, d):
    """The silver layer written as a catalog table, overwritten with
    another schema, and read by name."""
    name = "silver_despesas"  # one table, overwritten by the next call
    silver = md.silver(expenses(spark, d))
    save_table(silver.select("cod_orgao"), name)
    save_table(silver, name)
    return spark.table(name).groupBy("nome_orgao").agg(F.count(F.lit(1)).alias("linhas"), rnd(F.sum("valor_limpo"), 2).alias("total_gasto"))


@register("csv_roundtrip", "SELECT DISTINCT p_name AS descricao FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)")
def q_csv_roundtrip(spark, d):
    """Distinct descriptions out to CSV and back (the classification input)."""
    from ..sources.tables import fact
    path = md.scratch_path(spark, "csv", d)
    write_csv(fact(spark, d).select("descricao").distinct(), path)
    return read_csv(spark, path, "descricao STRING")


# ---------------------------------------------------------------- medallion

_SILVER = """SELECT ano AS ano_exercicio, codigoOrgao AS cod_orgao, nomeOrgao AS nome_orgao,
  TRY_CAST(replace(valor, ',', '.') AS DOUBLE) AS valor_limpo FROM expenses"""


@register("silver_clean", with_ctes(_SILVER, EXPENSES_CTE))
def q_silver_clean(spark, d):
    return md.silver(expenses(spark, d))


@register("bronze_layer", with_ctes("SELECT ano, codigoOrgao, nomeOrgao, valor, TRUE AS tem_data_ingestao FROM expenses", EXPENSES_CTE))
def q_bronze_layer(spark, d):
    """The stored layer; of the ingestion time only whether it is set."""
    path = md.bronze(spark, expenses(spark, d), md.scratch_path(spark, "bronze", d))
    from ..sources.files import read_layer
    return read_layer(spark, path).select("ano", "codigoOrgao", "nomeOrgao", "valor",
                                          F.col("data_ingestao").isNotNull().alias("tem_data_ingestao"))


@register("gold_agency_totals", with_ctes(
    f"SELECT nome_orgao, ROUND(SUM(valor_limpo), 4) AS total_gasto FROM ({_SILVER}) s GROUP BY 1", EXPENSES_CTE))
def q_gold_agency_totals(spark, d):
    from ..sources.files import read_layer
    paths = md.run_expenses_pipeline(spark, d)
    g = read_layer(spark, paths["gold"])
    return g.select("nome_orgao", rnd("total_gasto", 4).alias("total_gasto"))


@register("top5_agencies", with_ctes(
    f"SELECT nome_orgao, ROUND(SUM(valor_limpo), 4) AS total_gasto FROM ({_SILVER}) s GROUP BY 1 ORDER BY SUM(valor_limpo) DESC, nome_orgao LIMIT 5",
    EXPENSES_CTE))
def q_top5_agencies(spark, d):
    g = md.gold(md.silver(expenses(spark, d))).limit(5)
    return g.select("nome_orgao", rnd("total_gasto", 4).alias("total_gasto"))
