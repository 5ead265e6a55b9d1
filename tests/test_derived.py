"""Derived tables are rebuilt when an input file changes and reused otherwise."""

import os
import tempfile
import time

from tenderscope.sources.tables import derived_table


def test_derived_table_follows_its_inputs(spark):
    root = tempfile.mkdtemp(prefix="ts-derived-")
    src = os.path.join(root, "src.parquet")
    spark.range(10).write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src).selectExpr("id * 2 AS v")

    a = derived_table(spark, "t-test", [src], build)
    assert sorted(r.v for r in a.collect()) == [i * 2 for i in range(10)]
    derived_table(spark, "t-test", [src], build).collect()
    assert len(calls) == 1                       # same inputs → reused
    time.sleep(1.1)
    spark.range(20).write.mode("overwrite").parquet(src)
    c = derived_table(spark, "t-test", [src], build)
    assert len(calls) == 2 and c.count() == 20   # changed inputs → rebuilt
