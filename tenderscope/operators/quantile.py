"""Exact quantiles (linear interpolation, as pandas / DAX MEDIAN) by distributed
selection.

``percentile()`` buffers every distinct value of a group in one task, and a full
ordering shuffles them all.  Selection moves almost nothing: the rows are
counted per (group, high part of the value) with map-side combining, the running
counts tell which parts hold the wanted ranks, and only the rows of those parts
are looked at again.  The high part is the value on a logarithmic scale (a
monotone function, so parts are in value order); a part that still holds more
than ``ROWS`` rows of several values is cut into ``CELLS`` equal ranges and
counted again.  The last step counts the distinct values of the wanted parts.
Typical data take two passes over (keys, value), large ones three.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import broadcast_small, keys_list, materialize

#: parts per factor e of the value, ranges a large part is cut into, rows a part may hold at the end
SCALE, CELLS, ROWS = 512, 1024, 1_000_000
#: cuts at most (values beyond double precision, or packed around one point, cannot be cut further)
PASSES = 8


def _part(v: Column) -> Column:
    x = v.cast("double")
    place = F.floor(F.signum(x) * F.log1p(F.abs(x)) * SCALE)
    return F.when(F.isnan(x), F.lit(2**63 - 1)).otherwise(place)


def _holding(counts: DataFrame, group: list[str], order: str, probs) -> DataFrame:
    """Rows of ``counts`` that hold a wanted rank; ``_n0`` becomes the rows of the
    whole group before each one."""
    w = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = counts.withColumn("_all", F.coalesce("_all", F.sum("_n").over(w))).withColumn("_n0", F.col("_n0") + before)
    ranks = [edge((F.col("_all") - 1) * F.lit(float(p))) for p in probs for edge in (F.floor, F.ceil)]
    return run.where(reduce(Column.__or__, [(F.col("_n0") <= r) & (r < F.col("_n0") + F.col("_n")) for r in ranks]))


def _inside(base: DataFrame, parts: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The rows of ``base`` that fall into ``parts`` (they do not overlap)."""
    b, p = base.alias("b"), broadcast_small(parts.where("_lo < _hi"), rows).alias("p")
    same = reduce(Column.__and__, [F.col(f"b.`{k}`").eqNullSafe(F.col(f"p.`{k}`")) for k in by], F.col("b._part") == F.col("p._part"))
    found = b.join(p, same & F.col("_val").between(F.col("_lo"), F.col("_hi")))
    return found.select("b.*", *[f"p.{c}" for c in ("_lo", "_hi", "_n0", "_all")])


def exact_quantiles(df: DataFrame, by, value: str, probs, names=None) -> DataFrame:
    by = keys_list(by)
    probs = list(probs)
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    base = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_val")).withColumn("_part", _part(F.col("_val")))
    count = [F.count(F.lit(1)).alias("_n"), F.min("_val").alias("_lo"), F.max("_val").alias("_hi")]
    first = base.groupBy(*by, "_part").agg(*count).select("*", F.lit(0).cast("bigint").alias("_n0"), F.lit(None).cast("bigint").alias("_all"))
    parts = materialize(_holding(first, by, "_part", probs))
    keys, passes = [*by, "_part"], 0
    while True:
        rows, most = parts.agg(F.count(F.lit(1)), F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n")))).first()
        if (most or 0) <= ROWS or passes == PASSES:
            break
        lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
        cell = F.floor((F.col("_val").cast("double") - lo) / F.greatest(hi - lo, F.lit(1e-300)) * CELLS).alias("_cell")
        cut = _inside(base, parts, by, rows).groupBy(*keys, F.col("_lo").alias("_from"), "_n0", "_all", cell).agg(*count)
        cut = _holding(cut, [*keys, "_from"], "_cell", probs).select(*parts.columns)
        parts, passes = materialize(cut.unionByName(parts.where("_lo = _hi"))), passes + 1
    single = parts.where("_lo = _hi").select(*by, F.col("_lo").alias("_val"), "_n", "_n0", "_all")
    last = _inside(base, parts, by, rows).groupBy(*keys, "_lo", "_n0", "_all", "_val").agg(F.count(F.lit(1)).alias("_n"))
    last = _holding(last, [*keys, "_lo"], "_val", probs).select(*single.columns).unionByName(single)
    rank = lambda p: (F.col("_all") - 1) * F.lit(float(p))
    at = lambda r: F.max(F.when((F.col("_n0") <= r) & (r < F.col("_n0") + F.col("_n")), F.col("_val")))
    picked = last.groupBy(*by).agg(F.max("_all").alias("_all"), *[
        at(edge(rank(p))).alias(f"_{k}{i}") for i, p in enumerate(probs) for k, edge in (("lo", F.floor), ("hi", F.ceil))])
    low = lambda i: F.col(f"_lo{i}").cast("double")
    between = lambda i, p: low(i) + (rank(p) - F.floor(rank(p))) * (F.col(f"_hi{i}").cast("double") - low(i))
    return picked.select(*by, *[between(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))])
