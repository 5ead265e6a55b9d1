"""File sources and sinks.

Layer paths are folders on the cluster's shared storage; the format is a
parameter (parquet here; Delta where the jar is available)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def read_json_records(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON records (one object per line or arrays with multiLine) →
    DataFrame.  Pass a schema on large inputs: inference costs a full pass."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_json_inferred(spark: SparkSession, path: str, corrupt: str = "_corrupt_record") -> DataFrame:
    """S6 without a schema: every line as a VARIANT, the schema of all of them
    merged by one distributed aggregate, then one typed column per field, nested
    ones as structs.  A field that is missing in a record is null, one that is
    a number here and a text there is text, and a line that is no record is
    kept in ``corrupt``."""
    lines = spark.read.text(path).where(F.trim("value") != "").select("value", F.try_parse_json("value").alias("v"))
    found = lines.agg(F.schema_of_variant_agg("v")).first()[0] or "VOID"
    bad = F.when(F.col("v").isNull(), F.col("value")).alias(corrupt)
    if not found.startswith("OBJECT<"):
        return lines.select(bad)
    ddl = found.replace("OBJECT<", "STRUCT<").replace(": VARIANT", ": STRING").replace(": VOID", ": STRING").replace("ARRAY<VARIANT>", "ARRAY<STRING>")
    return lines.select(F.try_variant_get("v", "$", ddl).alias("r"), bad).select("r.*", corrupt)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; a null text becomes an empty cell.  The empty
    cell is written quoted (``""``): an unquoted one would leave a blank line
    in a one-column file, and CSV readers skip blank lines, losing the row."""
    out = df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, StringType)
                      else F.col(f"`{f.name}`") for f in df.schema.fields])
    out.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """S7 read-back: an empty text cell is null again."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.select(*[F.when(F.col(f"`{f.name}`") == "", F.lit(None)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by=None) -> None:
    """(over)write a catalog table; an overwrite replaces the schema."""
    w = df.write.mode(mode).option("overwriteSchema", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None) -> None:
    """Write a medallion layer to a path."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_years(df: DataFrame, path: str, year: str = "ano") -> None:
    """A layer with a folder per year.  Only the years in ``df`` are
    replaced; the files of all others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """All years by column name; a column that an old year lacks is null there."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def with_ingest_ts(df: DataFrame, col: str = "data_ingestao") -> DataFrame:
    """Stamp the ingestion time (kept out of compared outputs)."""
    return df.withColumn(col, F.current_timestamp())


def union_years(frames) -> DataFrame:
    """Stack yearly (or monthly, per-id) frames by column name;
    columns missing in some frames become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))
