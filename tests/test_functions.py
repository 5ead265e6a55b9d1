"""Column functions on the small edge frames (parsers, text, formats, DAX)."""

from pyspark.sql import functions as F

from tenderscope.functions import (brl_compact, bsub, clean_text, div, parse_br, parse_decimal_comma, parse_loose,
                                   parse_month)

MONEY = ["1.234,56", "1234.5", "12,5", "-3,00", "abc", "", None]


def _col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def test_three_parsers_disagree(spark):
    df = _col(spark, MONEY).select("i", parse_decimal_comma("v").alias("dc"), parse_br("v").alias("br"),
                                   parse_loose("v").alias("lo")).orderBy("i")
    rows = [tuple(r)[1:] for r in df.collect()]
    assert rows[0] == (None, 1234.56, None)          # 1.234,56
    assert rows[1] == (1234.5, 12345.0, 1234.5)      # plain 1234.5: P7 drops the dot on purpose
    assert rows[2] == (12.5, 12.5, 12.5)
    assert rows[3] == (-3.0, -3.0, 3.0)              # P8 loses the sign
    assert rows[4] == (None, None, None)
    assert rows[5] == (None, None, None)
    assert rows[6] == (None, None, None)


def test_parse_month(spark):
    df = _col(spark, ["03/2020", "13/2020", "3/2020", None]).select("i", parse_month("v").alias("m")).orderBy("i")
    got = [r.m for r in df.collect()]
    assert str(got[0]) == "2020-03-01"
    assert got[1:] == [None, None, None]


def test_clean_text(spark):
    df = _col(spark, [None, "", "!!!", "Água nº 5", "  Caneta   AZUL-esferográfica\t(10un) "]).select(
        "i", clean_text("v").alias("c")).orderBy("i")
    got = [r.c for r in df.collect()]
    assert got == ["", "", "", "água nº 5", "caneta azul esferográfica 10un"]


def test_brl_compact(spark):
    vals = [1234567890.0, 2500000.0, 1500.0, 999.994, 0.5, -12.0, None]
    df = _col(spark, vals, "double").select("i", brl_compact("v").alias("f")).orderBy("i")
    got = [r.f for r in df.collect()]
    assert got == ["R$ 1,23 bi", "R$ 2,50 mi", "R$ 1,50 mil", "R$ 999,99", "R$ 0,50", "-R$ 12,00", None]


def test_dax_blank_rules(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5.0, None), (3, None, 4.0), (4, 6.0, 0.0)], "i int, a double, b double")
    rows = df.select("i", bsub("a", "b").alias("d"), div("a", "b").alias("q")).orderBy("i").collect()
    assert [r.d for r in rows] == [None, 5.0, -4.0, 6.0]
    assert [r.q for r in rows] == [None, None, None, None]
