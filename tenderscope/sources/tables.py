"""Loaders for the driver tables and the star-schema frames built on them.

The mapping of the procurement schema onto the TPC-H-like tables:

  fact (one row per tender item)  lineitem ⨝ part ⨝ supplier
    id                 l_orderkey as string
    codigoItemCompra   l_partkey as string
    descricao          p_name       (also descricao_original, the map key)
    categoria_ia       p_type
    quantidade         l_quantity as bigint
    valor              l_extendedprice as decimal(19,4)
    cpfCnpjVencedor    l_suppkey as string
    nome               s_name
    tipoPessoa         PF for even l_linenumber, else PJ
    descUnidadeFornecimento  p_brand
    mes                first day of the l_shipdate month

Every frame is lazy: Catalyst prunes the parquet columns each query does not
use and pushes its filters into the scans.  The joins carry no broadcast
hint: both dimensions grow with the data, so Spark's own size check
(``autoBroadcastJoinThreshold`` on plan statistics, then AQE on the real
shuffle sizes) decides between a broadcast and a sort-merge join.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_COLUMNS = [
    "id", "codigoItemCompra", "descricao", "descricao_original", "categoria_ia",
    "quantidade", "valor", "cpfCnpjVencedor", "nome", "tipoPessoa",
    "descUnidadeFornecimento", "mes",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _signature(spark: SparkSession, paths) -> str:
    """Path, size and modification time of every input file, folded into one
    row by Spark (nothing but the listing is read).  Any file replaced, added or
    removed changes it, in stores without folder times too."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return hashlib.sha256(repr((sorted(paths), tuple(row))).encode()).hexdigest()[:24]


FACT_VERSION = "fact-v1"


_READ_CACHE: dict[tuple[str, str], DataFrame] = {}


def storage_root(spark: SparkSession) -> str:
    """Folder of derived tables: the configured shared checkpoint folder itself,
    so the applications of a cluster share them (a local session without one
    has a folder of its own)."""
    from ..session import ensure_checkpoint_dir
    found = ensure_checkpoint_dir(spark)
    return f"{(spark.conf.get('spark.checkpoint.dir', None) or found).rstrip('/')}/tenderscope"


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` was written to its end: its marker, written last, is there."""
    try:
        spark.read.schema("id long").parquet(f"{path}-complete")
    except AnalysisException:
        return False
    return True


def derived_table(spark: SparkSession, name: str, inputs, build, sort_by=None, fmt: str = "parquet", schema: str | None = None, partition_by=(),
                  compression: str | None = None) -> DataFrame:
    """A table Spark derives from input files, written once per input
    signature into the shared folder and read from there by every application.
    The read is kept per application and path (the path names the signature), so
    repeated queries skip re-listing the table and re-reading its footers."""
    path = f"{storage_root(spark)}/{name}-{_signature(spark, inputs)}"
    key = (spark.sparkContext.applicationId, path)
    if key in _READ_CACHE:
        return _READ_CACHE[key]
    if not _complete(spark, path):
        df = build()
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
        writer = df.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
        (writer.option("compression", compression) if compression else writer).save(path)
        spark.range(1, numPartitions=1).write.mode("overwrite").parquet(f"{path}-complete")
    reader = spark.read.format(fmt)
    out = (reader.schema(schema) if schema else reader).load(path)
    _READ_CACHE[key] = out
    return out


def fact(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """The item fact, built once per set of input files.

    The fact is the model's gold table: it is written (sorted by month within
    files, so month filters skip row groups) into the shared checkpoint
    folder under a key made of the input tables' sizes and modification times,
    and every query reads that table.  Changed inputs give a new key."""
    if not materialize:
        return fact_plan(spark, sf_dir)
    base = sf_dir.rstrip("/")
    return derived_table(spark, FACT_VERSION, [f"{base}/{t}.parquet" for t in ("lineitem", "part", "supplier")],
                         lambda: _dealt(fact_plan(spark, sf_dir), read_table(spark, sf_dir, "lineitem").count()), sort_by=["mes"])


#: item rows sorted and written by one task
FACT_ROWS = 300_000


def _dealt(items: DataFrame, rows: int) -> DataFrame:
    """The items dealt evenly over as many tasks as their number asks for.  An input
    split holds millions of packed rows, and its sort would hold them unpacked."""
    tasks = -(-rows // FACT_ROWS)
    return items.repartition(tasks, *items.columns) if tasks > 1 else items


def fact_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item fact (§1.1) as a lazy join plan, typed as the BI model pins it."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    sup = read_table(spark, sf_dir, "supplier")
    joined = li.join(part, li.l_partkey == part.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
    return joined.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_partkey").cast("string").alias("codigoItemCompra"),
        F.col("p_name").alias("descricao"),
        F.col("p_name").alias("descricao_original"),
        F.col("p_type").alias("categoria_ia"),
        F.col("l_quantity").cast("bigint").alias("quantidade"),
        F.col("l_extendedprice").cast("decimal(19,4)").alias("valor"),
        F.col("l_suppkey").cast("string").alias("cpfCnpjVencedor"),
        F.col("s_name").alias("nome"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("PF")).otherwise(F.lit("PJ")).alias("tipoPessoa"),
        F.col("p_brand").alias("descUnidadeFornecimento"),
        F.trunc(F.to_date("l_shipdate"), "MM").alias("mes"),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze item rows as the API lands them, before the header month is
    attached: everything is text, the value is Brazilian money ``1.234,56``.
    Stored once per input signature, like the landed files it stands for."""
    base = sf_dir.rstrip("/")
    return derived_table(spark, "bronze-items-v1", [f"{base}/lineitem.parquet", f"{base}/part.parquet"],
                         lambda: raw_items_plan(spark, sf_dir))


def raw_items_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    j = li.join(part, li.l_partkey == part.p_partkey)
    return j.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_partkey").cast("string").alias("codigoItemCompra"),
        F.col("l_linenumber").cast("string").alias("numero"),
        F.col("p_name").alias("descricao"),
        F.col("l_quantity").cast("bigint").cast("string").alias("quantidade"),
        F.translate(F.format_number("l_extendedprice", 2), ",.", ".,").alias("valor"),
        F.col("l_suppkey").cast("string").alias("cpfCnpjVencedor"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tender headers (``licitacoes``): one row per order."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.date_format("o_orderdate", "MM/yyyy").alias("mes/ano"),
        F.col("o_orderkey").alias("id"),
        F.create_map(F.lit("situacao"), F.col("o_orderstatus"), F.lit("prioridade"), F.col("o_orderpriority")).alias("licitacao"),
        F.to_date("o_orderdate").alias("dataAbertura"),
        F.col("o_orderstatus").alias("situacaoCompra"),
        F.col("o_orderpriority").alias("modalidadeLicitacao"),
        F.col("o_totalprice").alias("valor"),
    )


def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency expenses as landed (bronze): value is text."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.lit(2024).alias("ano"),
        F.col("n_nationkey").cast("string").alias("codigoOrgao"),
        F.col("n_name").alias("nomeOrgao"),
        F.col("c_acctbal").cast("string").alias("valor"),
    )


def description_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mapa_descricao`` on the test tables (see ``operators.joins``)."""
    from ..operators.joins import description_map as build
    return build(read_table(spark, sf_dir, "part"))
