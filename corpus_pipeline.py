"""From raw documents to training sequences: five stages, each one operator.

Every stage gets what the one before it kept, reread from Parquet, and all but
the last return the columns of ``documents``.  Null ids and texts, empty and
repeated rows, and extra columns pass through each stage as its operator
defines; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderscope.llm import mixing, packing, pii, simhash, toxicity
from tenderscope.llm.common import saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models score below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(docs, labels).where("score < 0.5").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind in brackets
    (n_chars follows the new text)."""
    found = pii.find(docs)
    text = F.when(F.col("row.text").isNotNull(), pii.redacted(F.col("row.text"), F.col("spans")))
    new = {"text": text, "n_chars": F.length("new").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return found.withColumn("new", text).select(
        *[(F.col("new") if c == "text" else new[c] if c == "n_chars" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs).select("row", F.explode(F.expr("array_repeat(1, cast(copies as int))")).alias("copy")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and their places in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: no SQL expresses the trained models or the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
