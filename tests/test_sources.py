"""Sources and sinks: catalog table overwrite with a new schema (S4/S8), CSV
round trip with nulls (S7), JSON records (S6), union with missing columns
(S11), month label (P1), column presence (P4)."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tenderscope.operators.dedup import select_present
from tenderscope.operators.filters import with_month
from tenderscope.sources.files import (read_csv, read_json_inferred, read_json_records, read_years, save_table, union_years, write_csv,
                                       write_years)
from tenderscope.sources.pages import assemble_items, assemble_pages, pages_of


def test_save_table_replaces_schema(spark):
    save_table(spark.range(3).withColumn("a", F.lit("x")), "ts_tab")
    save_table(spark.range(2).withColumn("b", F.lit(1.5)), "ts_tab")
    t = spark.table("ts_tab")
    assert t.columns == ["id", "b"] and t.count() == 2


def test_csv_round_trip_keeps_null_as_empty(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ts-csv-"), "d")
    write_csv(spark.createDataFrame([("caneta",), (None,), ("Água nº 5",)], "descricao string"), path)
    back = read_csv(spark, path, "descricao STRING")
    assert sorted(r.descricao or "" for r in back.collect()) == ["", "caneta", "Água nº 5"]


def test_json_records_and_union(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ts-json-"), "j")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, nome string").write.json(path)
    j = read_json_records(spark, path, "id LONG, nome STRING")
    u = union_years([j, spark.createDataFrame([(3, "PF")], "id long, tipoPessoa string")])
    rows = sorted((r.id, r.nome, r.tipoPessoa) for r in u.collect())
    assert rows == [(1, "a", None), (2, "b", None), (3, None, "PF")]


def test_month_label_and_presence(spark):
    df = with_month(spark.range(2), "03/2020")
    assert df.columns == ["mes/ano", "id"]
    sel, missing = select_present(df, ["id", "valor"])
    assert sel.columns == ["id"] and missing == ["valor"]
    none, missing = select_present(df, ["x", "y"])
    assert none is None and missing == ["x", "y"]


def test_inferred_records(spark):
    """Nested cells, missing and mixed fields, and lines that are no record."""
    path = os.path.join(tempfile.mkdtemp(prefix="ts-var-"), "r.txt")
    lines = ['{"id": 1, "cell": {"a": "x", "b": 2}, "v": 1.5, "tags": ["p", "q"]}', '{"id": 2, "cell": {"a": "y"}, "v": "1,5"}', '{"id": 3, "v": null}', '{"id": 4, "cell"', "", "nonsense"]
    with open(path, "w") as fh:
        fh.write("\n".join(lines))
    df = read_json_inferred(spark, path)
    assert dict(df.dtypes)["cell"] == "struct<a:string,b:bigint>" and dict(df.dtypes)["v"] == "string"
    rows = {r.id: r for r in df.collect() if r.id is not None}
    assert rows[1].cell.b == 2 and rows[1].tags == ["p", "q"] and rows[1].v == "1.5" and rows[2].cell.b is None and rows[2].v == "1,5"
    assert rows[3].cell is None and rows[3].v is None
    assert {r._corrupt_record for r in df.collect() if r._corrupt_record} == {"nonsense", '{"id": 4, "cell"'}
    empty = os.path.join(tempfile.mkdtemp(prefix="ts-var-"), "e.txt")
    open(empty, "w").write("bad\n")
    assert read_json_inferred(spark, empty).columns == ["_corrupt_record"]


def test_rewriting_one_year_leaves_the_others(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ts-year-"), "layer")
    write_years(spark.createDataFrame([(2019, 1), (2020, 2), (2021, 3)], "ano int, v int"), path)
    files = lambda: {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    write_years(spark.createDataFrame([(2020, 5, "new"), (2022, 6, "more")], "ano int, v int, tipo string"), path)
    after = files()
    kept = {k for k in before if "ano=2020" not in k[0]}
    assert all(after[k] == before[k] for k in kept) and not any(k in after for k in before if "ano=2020" in k[0])
    rows = sorted((r.ano, r.v, r.tipo) for r in read_years(spark, path).collect())
    assert rows == [(2019, 1, None), (2020, 5, "new"), (2021, 3, None), (2022, 6, "more")]


def test_failed_pages(spark):
    """The rules for failures: a failed header page ends its key, a failed item page drops its id."""
    recs = spark.range(60).select((F.col("id") % 3).alias("k"), F.col("id").alias("numero"))
    pages = pages_of(recs, ["k"], "numero", 4, ["numero"])
    bad = pages.withColumn("status", F.when((F.col("k") == 1) & (F.col("page_no") == 2), 500).otherwise(F.col("status")))
    schema = StructType([StructField("numero", LongType())])
    whole = {r.k: r.n for r in assemble_pages(pages, ["k"], schema).groupBy("k").agg(F.count("*").alias("n")).collect()}
    cut = {r.k: r.n for r in assemble_pages(bad, ["k"], schema).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert whole == {0: 20, 1: 20, 2: 20} and cut[0] == cut[2] == 20 and 0 < cut[1] < 20
    items, failed = assemble_items(bad, "k", schema)
    assert [r.k for r in failed.collect()] == [1] and {r.k for r in items.select("k").distinct().collect()} == {0, 2}
    assert pages.where("body = '[]'").count() == 3


def test_items_move_once_and_odd_ids_are_looked_up(spark):
    """full pages in order; assembling moves no page body; late and failed pages as before."""
    from tenderscope.sources.pages import pages_of_few
    recs = spark.createDataFrame([(k, n) for k in (1, 2, 3) for n in range(7)] + [(None, 1)], "k long, numero long")
    pages = pages_of_few(recs, ["k"], "numero", 3, ["numero"])
    got = {(r.k, r.page_no): r.body for r in pages.collect()}
    assert len(got) == 12 and got[1, 1] == '[{"numero":0},{"numero":1},{"numero":2}]' and got[1, 3] == '[{"numero":6}]' and got[1, 4] == "[]"
    late = pages.unionByName(spark.createDataFrame([(2, 5, '[{"numero":99}]', 500)], "k long, page_no int, body string, status int"))
    bad = late.withColumn("status", F.when((F.col("k") == 3) & (F.col("page_no") == 2), 500).otherwise(F.col("status")))
    items, failed = assemble_items(bad, "k", StructType([StructField("numero", LongType())]))
    assert sorted((r.k, r.numero) for r in items.collect()) == [(k, n) for k in (1, 2) for n in range(7)] and [r.k for r in failed.collect()] == [3]
    landed = spark.createDataFrame(bad.collect(), bad.schema)
    plan = assemble_items(landed, "k", StructType([StructField("numero", LongType())]))[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
