"""Joins of the item pipeline and the star schema (J1–J7, J9) and the
description map built from the data.

No join here carries a broadcast hint on a side that grows with the data:
Spark's statistics-based threshold and AQE's runtime re-plan choose a
broadcast only when the measured side is small, and fall back to a
sort-merge join otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from .util import BROADCAST_ROWS, broadcast_small, rnd



def attach_month(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Items LEFT JOIN the header's month on ``id`` (the header id is an
    integer, the item id a string).  Repeated header ids fan out; A5 cleans."""
    h = headers.select(F.col("id").cast("string").alias("id"), F.col("`mes/ano`"))
    return items.join(h, on="id", how="left")


def enrich_category(items: DataFrame, mapa: DataFrame) -> DataFrame:
    """Items INNER JOIN the description map; null descriptions drop out."""
    m = mapa.select("descricao_original", "categoria_ia", "confianca")
    return items.join(m, items["descricao"] == m["descricao_original"], "inner")


def unmatched(items: DataFrame, mapa: DataFrame) -> DataFrame:
    """The rows J2 loses."""
    m = mapa.select("descricao_original")
    return items.join(m, items["descricao"] == m["descricao_original"], "left_anti")


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, distinct ids and total value before and after a join, as one
    row (two global aggregates side by side)."""
    b = before.agg(
        F.count(F.lit(1)).alias("linhas_antes"),
        F.count_distinct("id").alias("ids_antes"),
        rnd(F.sum("valor").cast("double"), 4).alias("valor_antes"),
    )
    a = after.agg(
        F.count(F.lit(1)).alias("linhas_depois"),
        F.count_distinct("id").alias("ids_depois"),
        rnd(F.sum("valor").cast("double"), 4).alias("valor_depois"),
    )
    return b.join(F.broadcast(a), how="cross")


def with_map(fact: DataFrame, mapa: DataFrame) -> DataFrame:
    """Star join fact → map (left; the map key is unique)."""
    m = mapa.select("descricao_original", F.col("confianca"))
    return fact.join(m, on="descricao_original", how="left")


def filter_by_map(fact: DataFrame, mapa: DataFrame, pred) -> DataFrame:
    """Fact rows whose mapped description satisfies ``pred`` (semi join)."""
    keys = mapa.where(pred).select("descricao_original")
    return fact.join(keys, on="descricao_original", how="left_semi")


def with_calendar(fact: DataFrame, cal: DataFrame) -> DataFrame:
    """Fact → calendar on the first-of-month date.  The calendar holds one
    row per day of the covered period; it is broadcast where that is counted to
    be few (one absurd date would make millions)."""
    days = cal.limit(BROADCAST_ROWS + 1).count()
    c = cal.withColumnRenamed("Mes", "MesNum")  # names are case-insensitive: Mes vs mes
    return fact.join(broadcast_small(c, days), fact["mes"] == c["Date"], "left").drop("Date")


def filter_in(df: DataFrame, keys_df: DataFrame, keys) -> DataFrame:
    """Keep rows whose key is in a computed key list (semi join, null-safe)."""
    ks = keys_df.select(*keys).distinct()
    return _semi(df, ks, keys)


def _semi(df: DataFrame, ks: DataFrame, keys) -> DataFrame:
    lf, rt = df.alias("_sl"), ks.alias("_sr")
    cond = None
    for k in keys:
        c = F.col(f"_sl.`{k}`").eqNullSafe(F.col(f"_sr.`{k}`"))
        cond = c if cond is None else cond & c
    return lf.join(rt, cond, "left_semi")


def description_map(part: DataFrame) -> DataFrame:
    """The description → category map on the test tables: per ``p_name`` the
    most frequent ``p_type`` (ties: the smallest), confidence = its share of
    the name's rows, rounded to 2."""
    c = part.groupBy("p_name", "p_type").agg(F.count(F.lit(1)).alias("n"))
    best = c.groupBy("p_name").agg(
        F.min_by("p_type", F.struct(-F.col("n"), F.col("p_type"))).alias("categoria_ia"),
        F.max("n").alias("nbest"),
        F.sum("n").alias("ntot"),
    )
    return best.select(
        F.col("p_name").alias("descricao_original"),
        "categoria_ia",
        # half-up to 2 places in integer arithmetic (exact, no binary ties)
        (F.expr("(200 * nbest + ntot) div (2 * ntot)") / F.lit(100.0)).alias("confianca"),
    )
