"""Paged API ingest from landed page files.

The live pull requests page 1, 2, … of each (unit, month) — or of each tender
id for items — until the first empty page.  Here the pages are files already
landed, in one folder per unit and month (or batch of ids): one JSON line per
page, ``(page_no, status, body)`` with ``body`` a JSON array text.  Assembly is a
distributed plan: a per-key minimum of the stopping page over all files, a
filter, ``from_json`` and ``explode``; no page goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..operators.util import broadcast_small, materialize


def pages_of(records: DataFrame, keys, rid: str, page_size: int, body_cols) -> DataFrame:
    """Records as the pages a pull lands: about ``page_size`` of a key's records a
    page (by a hash of the record id, so no key is ordered in one task), all
    answered, and the empty page that ends the key."""
    keys = list(keys)
    count = records.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(page_size)).cast("int").alias("_np"))
    placed = records.join(count, on=keys).withColumn("page_no", (F.pmod(F.xxhash64(rid), F.col("_np")) + 1).cast("int"))
    # pages are numbered without holes: a page that got no record would end the key
    full = placed.select(*keys, "page_no").distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("page_no")).alias("_nos"))
    bodies = placed.groupBy(*keys, "page_no").agg(F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in body_cols]))).alias("body"))
    bodies = bodies.join(full, on=keys).select(*keys, F.array_position("_nos", F.col("page_no")).cast("int").alias("page_no"), "body")
    end = full.select(*keys, (F.size("_nos") + 1).alias("page_no"), F.lit("[]").alias("body"))
    return bodies.unionByName(end).withColumn("status", F.lit(200))


def pages_of_few(records: DataFrame, keys, rid: str, page_size: int, body_cols, on_page=None) -> DataFrame:
    """As ``pages_of``, for keys of few records each (a tender's items): the records
    of a key meet once and are cut into full pages in order of ``rid`` there, or lie
    on the page ``on_page(rid, number of pages)`` (a page without records is not landed)."""
    keys = list(keys)
    known = records.where(" and ".join(f"`{k}` is not null" for k in keys))
    body = F.struct(*[F.col(f"`{c}`") for c in body_cols])
    met = known.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(rid).alias("_at"), body.alias("_r")))).alias("_rs"))
    no = F.ceil(F.size("_rs") / F.lit(page_size)).cast("int")
    part = lambda i: F.transform(F.slice("_rs", (i - 1) * page_size + 1, page_size), lambda r: r["_r"])
    if on_page is not None:
        part = lambda i: F.transform(F.filter("_rs", lambda r: on_page(r["_at"], no) == i), lambda r: r["_r"])
    full = F.transform(F.sequence(F.lit(1), no), lambda i: F.struct(i.alias("page_no"), part(i).alias("rs")))
    end = F.array(F.struct((no + 1).alias("page_no"), F.slice(F.transform("_rs", lambda r: r["_r"]), 1, 0).alias("rs")))
    pages = met.select(*keys, F.explode(F.concat(F.filter(full, lambda p: F.size(p["rs"]) > 0), end)).alias("_p"))
    return pages.select(*keys, "_p.page_no", F.to_json("_p.rs").alias("body"), F.lit(200).alias("status"))


def read_pages(spark: SparkSession, path: str, schema: str, where: str | None = None) -> DataFrame:
    """Landed pages with the file each came from (``arquivo``).  ``where`` on the
    folder columns reads only those folders; a line that is no page at all is
    a failed request."""
    pages = spark.read.schema(schema).json(path)
    pages = pages.where(where) if where else pages
    return with_source(pages)


def with_source(pages: DataFrame) -> DataFrame:
    return pages.select("*", F.col("_metadata.file_name").alias("arquivo")).withColumn("status", F.coalesce("status", F.lit(500)))


def _is_stop(page: DataFrame):
    return (F.col("status") != 200) | (F.col("body") == "[]") | F.col("body").isNull()


def assemble_pages(pages: DataFrame, keys, record_schema: StructType) -> DataFrame:
    """Per key keep the pages before the first empty or failed page (the
    pages got before an error are kept), parse and explode the records."""
    keys = list(keys)
    stop = pages.where(_is_stop(pages)).groupBy(*keys).agg(F.min("page_no").alias("_stop"))
    kept = pages.join(stop, on=keys, how="left").where(
        F.col("_stop").isNull() | (F.col("page_no") < F.col("_stop")))
    recs = kept.select(*keys, F.explode(F.from_json("body", ArrayType(record_schema))).alias("_r"))
    return recs.select(*keys, "_r.*")


def assemble_items(pages: DataFrame, key: str, record_schema: StructType):
    """S3: like S2 per tender id, but a failed request before the end page
    drops the *whole id*.  Returns ``(items, failed_ids)``; the failures are a
    frame (to be written as a table), not a print."""
    bad, end = F.col("status") != 200, F.col("body") == "[]"
    seen = pages.groupBy(key).agg(
        F.min(F.when(end, F.col("page_no"))).alias("_end"), F.max("page_no").alias("_last"),
        F.min(F.when(bad, F.col("page_no"))).alias("_bad"), F.bool_or(bad).alias("_any_bad"))
    failed = F.when(F.col("_end").isNull(), F.col("_any_bad")).otherwise(F.coalesce(F.col("_bad") < F.col("_end"), F.lit(False)))
    seen = seen.select(key, "_end", "_last", failed.alias("_failed"))
    # only ids that failed or go on after their end page need a look-up: the pages themselves do not move
    odd = materialize(seen.where("_failed or _last > _end"))
    failed_ids = odd.where("_failed").select(key)
    look = broadcast_small(odd.where(F.col(key).isNotNull()).select(key, F.col("_end").alias("_cut"), "_failed"), odd.count())
    ok = pages.join(look, on=key, how="left").where(~F.coalesce("_failed", F.lit(False)) & (~F.coalesce(end, F.lit(False)))
                                                    & (F.col("_cut").isNull() | (F.col("page_no") < F.col("_cut"))))
    items = ok.select(key, F.explode(F.from_json("body", ArrayType(record_schema))).alias("_r")).select(key, "_r.*")
    return items, failed_ids
