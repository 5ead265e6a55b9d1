"""Invariants on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from tenderscope.operators import ranking as rk
from tenderscope.operators import series as se
from tenderscope.operators import shares as sh
from tenderscope.operators import tsa
from tenderscope.operators.joins import reconcile, unmatched
from tenderscope.operators.timeintel import time_intelligence
from tenderscope.sources.tables import description_map, fact, raw_items

SF_SMALL = "/root/testdata/sf0.001"


def test_shares_sum_to_one(spark):
    f = fact(spark, SF_SMALL)
    s = sh.share_of_total(f, f, ["categoria_ia"]).agg(F.sum("pct_total")).collect()[0][0]
    assert abs(s - 1) < 1e-5
    y = sh.share_of_year(f.withColumn("ano", F.year("mes")), ["categoria_ia", "ano", "mes"])
    for r in y.groupBy("categoria_ia", "ano").agg(F.sum("pct_ano").alias("s")).collect():
        assert abs(r.s - 1) < 1e-5


def test_ytd_in_december_is_year_total(spark):
    f = fact(spark, SF_SMALL)
    t = time_intelligence(f).where(F.month("mes") == 12)
    tot = {r.ano: r.v for r in f.groupBy(F.year("mes").alias("ano")).agg(F.sum("valor").cast("double").alias("v")).collect()}
    for r in t.collect():
        if r.ano in tot:
            assert abs(r.valor_ytd - tot[r.ano]) < 1e-3


def test_pareto_ends_at_one(spark):
    p = rk.pareto(fact(spark, SF_SMALL))
    assert abs(p.agg(F.max("pct_pareto")).collect()[0][0] - 1) < 1e-9


def test_decomposition_adds_up(spark):
    d = tsa.decompose_additive(se.series_frame(fact(spark, SF_SMALL)))
    bad = d.where("trend is not null and abs(trend + seasonal + resid - y) > 1e-6").count()
    assert bad == 0


def test_reconcile_before_equals_after_plus_lost(spark):
    items = raw_items(spark, SF_SMALL)
    mapa = description_map(spark, SF_SMALL).where(F.col("confianca") >= 0.3)
    after = items.join(mapa, items.descricao == mapa.descricao_original, "inner")
    lost = unmatched(items, mapa)
    assert items.count() == after.count() + lost.count()
    one = reconcile(items.withColumn("valor", F.lit(1).cast("decimal(19,4)")), after.withColumn("valor", F.lit(1).cast("decimal(19,4)"))).collect()[0]
    assert one.linhas_antes == one.linhas_depois + lost.count()
