"""Mixing sources to target weights by systematic sampling.

Sources, by code point and null last, weigh 3, 1, 2 and so on; together they
take ``share`` of all words.  A source's target is its weight's part, at most
``most`` times its size; what that cuts off goes to the others by weight.  The
closed form: with sources in order of cap per weight, the first ones whose cap
is below their part at that point are full, the rest divide what is left.

Within a source every document expects ``target / source_size`` copies.  The
running sum of expected copies plus one random offset per source is cut at the
integers, and a document is emitted once per integer crossed.  Documents run in
order of size class, so short and long ones are sampled alike and the words
taken stay near the target.

The running sum over a source that holds a third of all rows is not one task's
work: rows are numbered inside blocks (source, size class, 256 hash buckets)
and the blocks' counts (at most some ten thousand a source) are summed along
the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (3, 1, 2)
SHARE, MOST, SEED = 1.5, 2.0, "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def _before(c: Column, w) -> Column:
    return F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from ``sizes(source, size)``; the windows
    run over one row per source."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(n - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.select("source", "source_size", n.alias("n"), pick.alias("weight"),
                 (F.col("source_size") * most).alias("full"), F.sum("source_size").over(Window.partitionBy()).alias("words"))
    order = Window.orderBy(F.col("full") / F.col("weight"), "n")
    s = s.withColumn("level", (F.col("words") * share - _before(F.col("full"), order))
                     / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    is_full = F.col("level") * F.col("weight") >= F.col("full")
    rest = F.max(F.when(~is_full, F.struct(-F.col("full") / F.col("weight"), -F.col("n"), "level"))).over(Window.partitionBy())
    return s.select("source", "source_size",
                    F.when(is_full, F.col("full")).otherwise(F.col("weight") * rest["level"]).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """(row, size, source_size, target, copies): ``row`` holds the columns of
    ``docs`` (doc_id, text and source are used), ``copies`` how often the mix
    emits it.

    Null texts have size 0; a source without words has target 0; null sources
    are one source, null ids sort as the empty text, equal rows are sampled
    singly; an empty table gives no rows.  Reruns agree: the offsets come from
    ``seed``, the order from the md5 of the ids."""
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.source").alias("source"),
        F.coalesce(F.regexp_count("row.text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))).alias("h"))
    block = ["source", "digits", "head", "bucket"]
    rows = rows.withColumns({"digits": F.length(F.bin("size")), "head": F.substring(F.bin("size"), 1, 4),
                             "bucket": F.substring("h", 1, 2)})
    counts = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.withColumn("earlier", _before(F.col("rows"), Window.partitionBy("source").orderBy(*block[1:])))
    plan = counts.alias("c").join(targets(rows.select("source", "size"), weights, share, most).alias("t"),
                                  F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        *[F.col(f"c.{b}") for b in block], "earlier", "source_size", "target")
    numbered = rows.withColumn("k", F.row_number().over(Window.partitionBy(*block).orderBy("h", "size")))
    on = [F.col(f"r.{b}").eqNullSafe(F.col(f"p.{b}")) for b in block]
    at = numbered.alias("r").join(plan.alias("p"), on).select(
        "row", "size", "source_size", "target", (F.col("earlier") + F.col("k")).alias("i"),
        (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("r.source"), F.lit("")))), 1, 8), 16, 10)
         .cast("double") / 4294967296.0).alias("u"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))
    cut = lambda i: F.floor(F.col("u") + F.col("rate") * i)
    # rounding at a boundary must not add a copy beyond the rate's own ceiling
    copies = F.least(cut(F.col("i")) - cut(F.col("i") - 1), F.ceil("rate"))
    return at.select("row", "size", "source_size", "target", copies.cast("long").alias("copies"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
b AS (SELECT *, length(bin(size)) AS digits, substr(bin(size), 1, 4) AS head, substr(h, 1, 2) AS bucket FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS n, sum(source_size) OVER () AS words FROM s),
w AS (SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap FROM n),
l AS (SELECT *, (words * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size,
             CASE WHEN level * weight >= cap THEN cap
                  ELSE weight * (SELECT level FROM l AS m WHERE m.level * m.weight < m.cap ORDER BY m.cap / m.weight, m.n LIMIT 1) END AS target
      FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY digits, head, bucket, h, size) AS i FROM b),
j AS (SELECT r.doc_id, r.size, t.source_size, t.target, r.i,
             CAST(('0x' || substr(md5('mix-1' || coalesce(r.source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(u + rate * i) - floor(u + rate * (i - 1)), ceil(rate)) AS BIGINT) * size AS taken
FROM j
"""
