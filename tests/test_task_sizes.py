"""The rows one task holds."""

from pyspark.sql import functions as F

from tenderscope.operators import series as se
from tenderscope.sources import tables


def test_fact_is_dealt_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "FACT_ROWS", 100)
    items = spark.range(5_000).select("id", (F.col("id") % 7).cast("string").alias("nome")).coalesce(1)
    sizes = [r["count"] for r in tables._dealt(items, 5_000).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 40 and sum(sizes) == 5_000 and max(sizes) < 200


def test_interpolation_sorts_no_filled_rows(spark):
    rows = [("a", "2020-02-01", None), ("a", "2020-03-01", 1.0), ("a", "2020-06-01", 4.0), ("a", "2020-07-01", None), ("a", "2020-08-01", None),
            ("b", "2020-01-01", None), ("b", "2020-02-01", None), (None, "2020-01-01", 5.0), ("a", None, 9.0)]
    s = spark.createDataFrame(rows, "series_id string, mes string, y double").withColumn("mes", F.to_date("mes"))
    out = se.interpolate_linear(s)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.series_id, r.mes.month): (r.y, r.y_interp) for r in out.collect()}
    assert got == {("a", 2): (None, None), ("a", 3): (1.0, 1.0), ("a", 4): (None, 2.0), ("a", 5): (None, 3.0), ("a", 6): (4.0, 4.0),
                   ("a", 7): (None, 4.0), ("a", 8): (None, 4.0), ("b", 1): (None, None), ("b", 2): (None, None), (None, 1): (5.0, 5.0)}
