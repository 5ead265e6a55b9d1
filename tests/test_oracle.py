"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); rows-only queries must run."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "valor_total" in df.columns


def test_all_queries_match_oracle(spark):
    from tools.oracle_check import compare
    from tenderscope.plans import catalog
    res = compare(spark, SF_SMALL, names=sorted(catalog.queries()), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    assert not bad, bad
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())
