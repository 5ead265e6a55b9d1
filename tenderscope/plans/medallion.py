"""Bronze → silver → gold pipelines.

Layers are written under a base folder on shared storage (by default the
session's ``spark.checkpoint.dir``); each layer boundary on disk also cuts
the lineage, so a lost executor only recomputes from the last layer."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.parse import parse_decimal_comma
from ..operators.joins import attach_month
from ..sources.files import read_layer, with_ingest_ts, write_layer
from ..sources.pages import assemble_items, assemble_pages, pages_of, pages_of_few, with_source
from ..sources.tables import derived_table, expenses, read_table, storage_root


def scratch_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    """A folder on shared storage per application, name and input: a later call overwrites it, so none pile up."""
    app = spark.sparkContext.applicationId
    return f"{storage_root(spark)}/scratch/{app}/{name}-{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"


def bronze(spark: SparkSession, raw: DataFrame, path: str) -> str:
    """B1: raw records + ingestion time, overwrite."""
    write_layer(with_ingest_ts(raw), path)
    return path


def silver(df: DataFrame) -> DataFrame:
    """B2: rename, parse the decimal-comma value, select."""
    r = df.withColumnsRenamed({"ano": "ano_exercicio", "codigoOrgao": "cod_orgao", "nomeOrgao": "nome_orgao"})
    r = r.withColumn("valor_limpo", parse_decimal_comma("valor"))
    return r.select("ano_exercicio", "cod_orgao", "nome_orgao", "valor_limpo")


def gold(df: DataFrame) -> DataFrame:
    """Total per agency, largest first."""
    g = df.groupBy("nome_orgao").agg(F.sum("valor_limpo").alias("total_gasto"))
    return g.orderBy(F.desc("total_gasto"), F.asc("nome_orgao"))


def run_expenses_pipeline(spark: SparkSession, sf_dir: str, base: str | None = None) -> dict:
    base = base or scratch_path(spark, "medallion", sf_dir)
    paths = {k: f"{base}/{k}" for k in ("bronze", "silver", "gold")}
    bronze(spark, expenses(spark, sf_dir), paths["bronze"])
    write_layer(silver(read_layer(spark, paths["bronze"])), paths["silver"])
    write_layer(gold(read_layer(spark, paths["silver"])), paths["gold"])
    return paths


# ---------------------------------------------------------------- paged ingest on the test tables

HEADER_RECORD = StructType([
    StructField("id", LongType()), StructField("valor", DoubleType()), StructField("modalidade", StringType()),
])
ITEM_RECORD = StructType([
    StructField("numero", LongType()), StructField("codigoItemCompra", StringType()),
    StructField("quantidade", LongType()), StructField("valor", StringType()),
    StructField("cpfCnpjVencedor", StringType()),
])


#: landed page files: the folder columns come last
HEADER_PAGES = "`mes/ano` string, page_no int, body string, status int, unidade string, lote int"
ITEM_PAGES = "id bigint, page_no int, body string, status int, lote int"


def header_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header pages per (unit, month): orders by status and month, 25 a page, a folder each."""
    o = read_table(spark, sf_dir, "orders")
    recs = o.select(
        F.col("o_orderstatus").alias("unidade"), F.date_format("o_orderdate", "MM/yyyy").alias("mes/ano"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("lote"),
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("valor"), F.col("o_orderpriority").alias("modalidade"))
    return pages_of(recs, ["unidade", "mes/ano", "lote"], "id", 25, ["id", "valor", "modalidade"])


_ITEM_BODY = ["numero", "codigoItemCompra", "quantidade", "valor", "cpfCnpjVencedor"]


def item_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the tenders (lineitems of an order), ids dealt over eight folders."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("id"), F.pmod("l_orderkey", F.lit(8)).cast("int").alias("lote"),
        F.col("l_linenumber").cast("long").alias("numero"), F.col("l_partkey").cast("string").alias("codigoItemCompra"),
        F.col("l_quantity").cast("long").alias("quantidade"), F.translate(F.format_number("l_extendedprice", 2), ",.", ".,").alias("valor"),
        F.col("l_suppkey").cast("string").alias("cpfCnpjVencedor"))


def item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item pages per tender id, 3 items a page, every request answered."""
    return pages_of_few(item_records(spark, sf_dir), ["id", "lote"], "numero", 3, _ITEM_BODY)


def first_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item pages as the first pull lands them: an item lies on page 1 + number mod
    (pages of its id), and the request of a page fails where 17 divides id + page."""
    pages = pages_of_few(item_records(spark, sf_dir), ["id", "lote"], "numero", 3, _ITEM_BODY, on_page=lambda at, no: at % no + 1)
    failed = (F.col("body") != "[]") & ((F.col("id") + F.col("page_no")) % 17 == 0)
    return pages.select("id", "lote", "page_no", F.when(~failed, F.col("body")).alias("body"), F.when(failed, 500).otherwise(200).alias("status"))


def landing_zone(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The landed page files of the test tables, written once per input signature, as a frame of pages."""
    base = sf_dir.rstrip("/")
    if kind == "headers":
        pages = derived_table(spark, "landed-headers-v2", [f"{base}/orders.parquet"], lambda: header_pages(spark, sf_dir),
                              fmt="json", schema=HEADER_PAGES, partition_by=["unidade", "lote"])
    else:
        name, build = ("landed-items-v3", item_pages) if kind == "items" else ("landed-items-first-v1", first_item_pages)
        pages = derived_table(spark, name, [f"{base}/lineitem.parquet"], lambda: build(spark, sf_dir),
                              fmt="json", schema=ITEM_PAGES, partition_by=["lote"], compression="gzip")
    return with_source(pages)


def paged_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = assemble_pages(landing_zone(spark, sf_dir, "headers"), ["unidade", "mes/ano"], HEADER_RECORD)
    return got.withColumnRenamed("unidade", "org")


def paged_items(spark: SparkSession, sf_dir: str):
    return assemble_items(landing_zone(spark, sf_dir, "items"), "id", ITEM_RECORD)


def first_pull(spark: SparkSession, sf_dir: str):
    """S3 over the first pull, in which requests failed: its items and the ids to be pulled again."""
    return assemble_items(landing_zone(spark, sf_dir, "items-first"), "id", ITEM_RECORD)


def items_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 items → J1 month from the S2 headers → A5 drop exact duplicates."""
    items, _failed = paged_items(spark, sf_dir)
    items = items.withColumn("id", F.col("id").cast("string"))
    h = paged_headers(spark, sf_dir).select("id", "`mes/ano`")
    return attach_month(items, h).dropDuplicates()
