"""failed requests of the first pull are found."""

import os
import tempfile

from tenderscope.plans.q_ingest import q_paged_failed_ids


def test_failed_ids_of_the_first_pull(spark):
    d = tempfile.mkdtemp(prefix="ts-failed-")
    rows = [(i, n, i, 1, 2.0 + n, 1.0) for i in range(1, 60) for n in range(1, 1 + i % 8)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double") \
        .write.parquet(os.path.join(d, "lineitem.parquet"))
    pages = lambda i: -(-(i % 8) // 3)
    want = {i for i in range(1, 60) for n in range(1, 1 + i % 8) if (i + 1 + n % pages(i)) % 17 == 0}
    assert want and sorted(r.id for r in q_paged_failed_ids(spark, d).collect()) == sorted(want)
