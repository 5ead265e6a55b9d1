"""Ranks, running sums and quantiles over more distinct keys than any sample
of the partitioning holds, with ties, a hot group, nulls and extra columns."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenderscope.operators.ordered import ordered_stats
from tenderscope.operators.quantile import exact_quantiles


@pytest.fixture(params=["true", "false"])
def reuse(spark, request):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield
    spark.conf.set("spark.sql.exchange.reuse", old)


def frame(spark):
    rng = np.random.default_rng(11)
    n = 24_000
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", None], n))
    value = np.where(rng.random(n) < 0.4, rng.integers(0, 50, n) * 100, rng.integers(0, 10**9, n)) / 100
    rows = [(i, g, None if i % 997 == 0 else float(v), f"name {i}", "x" * (i % 40)) for i, (g, v) in enumerate(zip(group, value))]
    return spark.createDataFrame(rows, "id long, g string, v double, name string, pad string").withColumn("v", F.col("v").cast("decimal(18,2)")).repartition(13)


@pytest.mark.parametrize("part", [(), ("g",)])
def test_ranks_match_windows(spark, reuse, part):
    df = frame(spark)
    w = Window.partitionBy(*part).orderBy(F.col("v").desc_nulls_last())
    want = df.select("id", F.rank().over(w).alias("_rank"), F.dense_rank().over(w).alias("_dense"),
                     F.sum("v").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("_cum"))
    got = ordered_stats(df, part, "v")
    assert set(df.columns) < set(got.columns)
    bring = lambda d: sorted((r.id, r._rank, r._dense, r._cum) for r in d.collect())
    assert bring(got) == bring(want)


@pytest.mark.parametrize("by", [(), ("g",)])
def test_quantiles_match_percentile(spark, reuse, by):
    df = frame(spark)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = df.groupBy(*by).agg(F.percentile(F.col("v").cast("double"), probs).alias("q"))
    got = exact_quantiles(df, by, "v", probs, list("abcde"))
    key = lambda r: tuple(str(r[k]) for k in by)
    left = {key(r): [r[c] for c in "abcde"] for r in got.collect()}
    right = {key(r): r.q for r in want.collect()}
    assert left.keys() == right.keys()
    for k in left:
        assert left[k] == pytest.approx(right[k], rel=1e-12)
