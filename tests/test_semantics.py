"""Edge rules the driver tables never hit (FIXTURES §3), each on a small frame."""

import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tenderscope.operators import classify as cl
from tenderscope.operators import forecast as fc
from tenderscope.operators import ranking as rk
from tenderscope.operators import series as se
from tenderscope.operators import tsa
from tenderscope.operators.dedup import count_duplicates
from tenderscope.operators.joins import attach_month
from tenderscope.operators.quantile import exact_quantiles
from tenderscope.sources.pages import assemble_items, assemble_pages
from tenderscope.plans.medallion import HEADER_RECORD, ITEM_RECORD

FACT_SCHEMA = "id string, nome string, cpfCnpjVencedor string, categoria_ia string, valor decimal(19,4), mes date"


def _fact(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(*r[:4], Decimal(str(r[4])), r[5]) for r in rows], FACT_SCHEMA)


def test_tied_top_supplier_has_no_name(spark):
    d = dt.date(2020, 1, 1)
    f = _fact(spark, [("1", "A", "1", "c", 10, d), ("2", "B", "2", "c", 10, d), ("3", "C", "3", "c", 5, d)])
    r = rk.top1(f, "nome").collect()[0]
    assert r.top_nome is None and r.top_valor == 10.0


def test_concentration_counts_ties_at_rank_n(spark):
    d = dt.date(2020, 1, 1)
    vals = [50, 40, 30, 20, 10, 10, 5]
    f = _fact(spark, [(str(i), f"S{i}", str(i), "c", v, d) for i, v in enumerate(vals)])
    r = rk.concentration(f, 5).collect()[0]
    assert r.valor_top5 == 160.0                     # both suppliers tied at #5 count
    assert abs(r.pct_top5 - 160 / 165) < 1e-6


def test_pareto_ties_share_one_figure_and_end_at_one(spark):
    d = dt.date(2020, 1, 1)
    f = _fact(spark, [("1", "A", "1", "c", 10, d), ("2", "B", "2", "c", 10, d), ("3", "C", "3", "c", 5, d)])
    got = {r.nome: r.pct_pareto for r in rk.pareto(f).collect()}
    assert got["A"] == got["B"] == 0.8 and got["C"] == 1.0


def test_join_fan_out_then_dedup(spark):
    items = spark.createDataFrame([("7", "x"), ("7", "x"), ("8", "y")], "id string, descricao string")
    headers = spark.createDataFrame([(7, "01/2020"), (7, "02/2020"), (8, "01/2020")], "id long, `mes/ano` string")
    j = attach_month(items, headers)
    assert j.count() == 5
    assert j.dropDuplicates().count() == 3
    assert count_duplicates(j, atomic_only=False).collect()[0].duplicados == 2


def test_paging_rules(spark):
    def page(key, n, status, body):
        return (*key, n, status, body)
    rec = '[{"id": %d, "valor": 1.0, "modalidade": "m"}]'
    pages = spark.createDataFrame([
        page(("o", "01/2020"), 1, 200, rec % 1), page(("o", "01/2020"), 2, 200, rec % 2),
        page(("o", "01/2020"), 3, 500, rec % 3), page(("o", "01/2020"), 4, 200, rec % 4),   # failed page 3: keep 1, 2
        page(("o", "02/2020"), 1, 200, rec % 5), page(("o", "02/2020"), 2, 200, "[]"),
        page(("o", "02/2020"), 3, 200, rec % 6),                                              # empty page 2 ends the month
    ], "org string, `mes/ano` string, page_no int, status int, body string")
    got = sorted(r.id for r in assemble_pages(pages, ["org", "mes/ano"], HEADER_RECORD).collect())
    assert got == [1, 2, 5]

    irec = '[{"numero": %d, "codigoItemCompra": "p", "quantidade": 1, "valor": "1,00", "cpfCnpjVencedor": "s"}]'
    ipages = spark.createDataFrame([
        (10, 1, 200, irec % 1), (10, 2, 500, irec % 2), (10, 3, 200, "[]"),   # id 10 fails → dropped whole
        (11, 1, 200, irec % 1), (11, 2, 200, "[]"), (11, 3, 500, irec % 3),   # failure after the end page is never requested
    ], "id long, page_no int, status int, body string")
    items, failed = assemble_items(ipages, "id", ITEM_RECORD)
    assert sorted((r.id, r.numero) for r in items.collect()) == [(11, 1)]
    assert [r.id for r in failed.collect()] == [10]


def test_gap_interpolation(spark):
    ms = [dt.date(2020, m, 1) for m in (1, 2, 5, 6)] + [dt.date(2021, 6, 1)]
    s = spark.createDataFrame([("a", m, float(i + 1)) for i, m in enumerate(ms)], "series_id string, mes date, y double")
    mm = se.missing_months(s).collect()[0]
    assert (mm.meses, mm.meses_faltantes) == (18, 13)
    got = {r.mes: r.y_interp for r in se.interpolate_linear(s).collect()}
    assert got[dt.date(2020, 3, 1)] == 2 + (3 - 2) * 1 / 3
    assert abs(got[dt.date(2020, 12, 1)] - (4 + (5 - 4) * 6 / 12)) < 1e-12


def test_decomposition_needs_two_periods(spark):
    rows = []
    for sid, n in (("short", 23), ("ok", 24)):
        for i in range(n):
            rows.append((sid, dt.date(2000 + i // 12, i % 12 + 1, 1), float(i + (i % 12))))
    s = spark.createDataFrame(rows, "series_id string, mes date, y double")
    d = tsa.decompose_additive(s)
    assert {r.series_id for r in d.select("series_id").distinct().collect()} == {"ok"}
    for r in d.where("trend is not null").collect():
        assert abs(r.trend + r.seasonal + r.resid - r.y) < 1e-9


def test_score_threshold_and_ties(spark):
    cats = spark.createDataFrame([("b", 1, [0.0, 1.0]), ("a", 0, [1.0, 0.0]), ("c", 2, [1.0, 0.0])],
                                 "name string, _ord int, vec array<double>")
    row = cl.catalogue_blocks(cats)
    v = 0.25
    texts = spark.createDataFrame([
        (1, [1.0, 0.0]),                       # ties a and c exactly → lowest index a
        (2, [v, math.sqrt(1 - v * v)]),        # cos with a = 0.25 → at threshold
        (3, [0.249, math.sqrt(1 - 0.249 ** 2)]),
    ], "id int, embedding array<double>")
    # only one category to check the threshold: a
    only_a = cl.catalogue_blocks(cats.where("name = 'a'"))
    best = {r.id: (r.best_name, r.categoria_ia, r.confianca) for r in cl.apply_threshold(cl.score_best(texts, only_a)).collect()}
    assert best[2][1] == "a" and best[3][1] == "Outros / Necessita Revisão" and best[3][2] == 0.25
    tie = cl.score_best(texts.where("id = 1"), row).collect()[0]
    assert tie.best_name == "a"


def test_empty_description_gets_no_description_label(spark):
    cats = spark.createDataFrame([("a", 0, [1.0, 0.0])], "name string, _ord int, vec array<double>")
    d = spark.createDataFrame([("!!!", [1.0, 0.0]), (None, [1.0, 0.0]), ("Água nº 5", [1.0, 0.0])],
                              "descricao string, embedding array<double>")
    got = {r.descricao_original: (r.categoria_ia, r.confianca) for r in cl.build_map(d, cl.catalogue_blocks(cats)).collect()}
    assert got["!!!"] == ("Sem Descrição", 0.0) and got[None] == ("Sem Descrição", 0.0)
    assert got["Água nº 5"] == ("a", 1.0)


def test_large_catalogue(spark):
    vec = lambda i: [1.0 if k == i else 0.0 for k in range(60)]
    cats = spark.createDataFrame([(f"c{i}", i, vec(i)) for i in range(60)], "name string, _ord int, vec array<double>")
    d = spark.createDataFrame([(f"t{i}", vec(i)) for i in range(60)] + [("no vector", None)], "descricao string, embedding array<double>")
    got = {r.descricao_original: (r.categoria_ia, r.confianca) for r in cl.build_map(d, cl.catalogue_blocks(cats)).collect()}
    assert got == {**{f"t{i}": (f"c{i}", 1.0) for i in range(60)}, "no vector": ("Outros / Necessita Revisão", None)}


def test_falling_forecast_floors_at_zero_and_blanks_interval(spark):
    rows = [(str(i), "S", "1", "c", 1000 - 80 * i, dt.date(2020 + i // 12, i % 12 + 1, 1)) for i in range(13)]
    f = _fact(spark, rows)
    out = fc.with_interval(fc.linear_forecast(f)).orderBy("mes").collect()
    last = out[-1]
    assert last.valor_previsto == 0.0 and last.ic_superior is None and last.ic_inferior is None
    assert out[0].valor_previsto > 0


def test_exact_quantiles_on_a_hot_group(spark):
    random.seed(1)
    rows = [("hot", random.random() * 100) for _ in range(3000)] + [(f"k{i % 7}", random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q25, r.q50) for r in exact_quantiles(df, ["k"], "v", [0.25, 0.5], ["q25", "q50"]).collect()}
    by = {}
    for k, v in rows:
        by.setdefault(k, []).append(v)
    for k, vs in by.items():
        assert abs(got[k][0] - np.quantile(vs, 0.25)) < 1e-9
        assert abs(got[k][1] - np.quantile(vs, 0.5)) < 1e-9
    tot = exact_quantiles(df, [], "v", [0.5], ["m"]).collect()[0].m
    assert abs(tot - np.median([v for _, v in rows])) < 1e-9


def test_ordered_stats_match_window_semantics_on_a_hot_group(spark):
    from tenderscope.operators.ordered import ordered_stats
    random.seed(7)
    rows = [("hot", float(random.randint(0, 300))) for _ in range(4000)] + [(f"k{i % 5}", float(i % 13)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = ordered_stats(df, ["g"], "v").select("g", "v", "_rank", "_dense", "_cum").distinct().collect()
    by = {}
    for g, v in rows:
        by.setdefault(g, []).append(v)
    for r in got:
        vs = by[r.g]
        assert r._rank == 1 + sum(1 for x in vs if x > r.v)
        assert r._dense == 1 + len({x for x in vs if x > r.v})
        assert abs(r._cum - sum(x for x in vs if x >= r.v)) < 1e-6
    glob = ordered_stats(df, [], "v").select("v", "_dense").distinct().collect()
    allv = sorted({v for _, v in rows}, reverse=True)
    for r in glob:
        assert r._dense == allv.index(r.v) + 1


def test_filter_context_rules(spark):
    from tenderscope.operators import quality as dq
    from tenderscope.operators import shares as sh
    from tenderscope.operators.filters import apply_slicers
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    f = _fact(spark, [("1", "A", "1", "x", 10, d1), ("2", "A", "1", "x", 30, d2), ("3", "B", "2", "y", 60, d1),
                      ("4", "B", "2", "Sem Descrição", 5, d1), ("5", "B", "2", None, 5, d2)])
    sliced = apply_slicers(f, categories=["x", "y"], months=["2020-01-01"])
    # H1: the divisor is the unsliced total (110), not the sliced one (70)
    h1 = {r.categoria_ia: r.pct_total for r in sh.share_of_total(sliced, f, ["categoria_ia"]).collect()}
    assert h1 == {"x": round(10 / 110, 6), "y": round(60 / 110, 6)}
    # H2: the divisor is the category's all-time total, months lifted
    h2 = {r.categoria_ia: r.pct_categoria for r in sh.share_of_category(sliced, f, ["categoria_ia"]).collect()}
    assert h2 == {"x": 0.25, "y": 1.0}
    # The category filter is replaced; the month slicer stays
    by_month = apply_slicers(f, months=["2020-01-01"])
    d = {r.categoria_ia: (r.qtd_linhas, r.qtd_sem_categoria) for r in
         dq.uncategorised(sliced, ["categoria_ia"], unsliced_by_category=by_month).collect()}
    assert d == {"x": (1, 1), "y": (1, 1)}


def test_cast_columns_gives_null_for_bad_or_overflowing_values(spark):
    from tenderscope.operators.filters import cast_columns
    df = spark.createDataFrame([("1.5", 1), ("x", 2), ("1" * 30, 3), (None, 4)], "valor string, n int")
    got = [r.valor for r in cast_columns(df, {"valor": "decimal(19,4)"}).orderBy("n").collect()]
    assert [None if v is None else float(v) for v in got] == [1.5, None, None, None]


def test_filled_series_has_no_gap(spark):
    from tenderscope.operators import series as se
    df = spark.sql("select 's' series_id, date'2020-01-01' mes, 1D y union all select 's', date'2020-04-01', 4D")
    assert [r.y for r in se.filled(df).orderBy("mseq").collect()] == [1.0, 2.0, 3.0, 4.0]


def test_supplier_detail_total_row_has_no_rank(spark):
    from decimal import Decimal
    from tenderscope.plans import reports as rp
    rows = [("a", "1", "x", 2, Decimal(10)), ("a", "1", "y", 1, Decimal(5)), ("b", "2", "x", 1, Decimal(20))]
    f = spark.createDataFrame(rows, "nome string, cpfCnpjVencedor string, id string, quantidade long, valor decimal(19,4)")
    got = [(r.rank, r.nome, r.qtd_licitacoes, r.valor_total) for r in rp.supplier_detail(f, f, with_total=True).collect()]
    assert got == [(1, "b", 1, 20.0), (2, "a", 2, 15.0), (None, None, 2, 35.0)]


def test_ten_thousand_categories(spark):
    """Blocks and their bounds give the best category of all, and the first of equal ones."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    cats = centres[rng.integers(0, 40, 10_000)] + rng.normal(scale=0.05, size=(10_000, 16))
    cats[7_000:7_050] = cats[100:150] * 2  # same direction, later in the catalogue
    cats[9_999] = 0
    texts = np.vstack([cats[rng.integers(0, 9_999, 250)] + rng.normal(scale=0.02, size=(250, 16)), cats[100:150], rng.normal(size=(20, 16))])
    c = spark.createDataFrame([(f"c{i:05d}", i, v.tolist()) for i, v in enumerate(cats)], "name string, _ord int, vec array<double>")
    t = spark.createDataFrame([(f"t{i}", v.tolist()) for i, v in enumerate(texts)] + [("none", None), ("zero", [0.0] * 16)], "descricao string, embedding array<double>")
    blocks = cl.catalogue_blocks(c)
    assert blocks.count() > 30 and blocks.agg(F.max(F.size("members"))).first()[0] < 2 * cl.BLOCK
    got = {r.descricao: (r.best_name, r.best_score) for r in cl.score_best(t, blocks, key="descricao").collect()}
    with np.errstate(invalid="ignore"):
        cos = texts @ cats.T / (np.linalg.norm(texts, axis=1)[:, None] * np.linalg.norm(cats, axis=1))
    cos = np.nan_to_num(cos, nan=-2)
    for i in range(len(texts)):
        name, score = got[f"t{i}"]
        assert abs(score - cos[i].max()) < 1e-9 and cos[i][int(name[1:])] > cos[i].max() - 1e-9
    assert got["none"] == got["zero"] == (None, None)
    exact = spark.createDataFrame([("b", 1, [2.0, 0.0]), ("a", 0, [1.0, 0.0]), ("z", 2, [0.0, 1.0]), ("y", 3, [-1.0, 0.1])], "name string, _ord int, vec array<double>")
    small = cl.catalogue_blocks(exact, size=1)
    assert small.count() > 2
    r = cl.score_best(spark.createDataFrame([("q", [3.0, 0.0])], "descricao string, embedding array<double>"), small, key="descricao").first()
    assert (r.best_name, r.best_score) == ("a", 1.0)


def test_large_search_is_dealt_into_bounded_cells(spark):
    """A catalogue as large as the texts: no row carries every block, copies and odd vectors included."""
    rng = np.random.default_rng(5)
    cats, texts = rng.normal(size=(1_500, 8)), rng.normal(size=(1_200, 8))
    cats[1_000:1_100] = cats[7]  # copies: the first is the best of them
    texts[:20] = cats[7]
    c = spark.createDataFrame([(f"c{i}", i, v.tolist()) for i, v in enumerate(cats)] + [("odd", 9_000, [math.inf] * 8), ("short", 9_001, [1.0])], "name string, _ord int, vec array<double>")
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(texts)] + [(None, [1.0] * 8), (9_000, [None] * 8)], "id long, embedding array<double>")
    blocks = cl.catalogue_blocks(c, size=32)
    assert blocks.columns == ["block", "members"]
    assert cl._deals(300_000) * cl.SIDE >= 300_000 and cl._deals(1) == 1
    got = {r.id: (r.best_name, r.best_score) for r in cl.score_best(t, blocks, key="id").collect()}
    cos = texts @ cats.T / (np.linalg.norm(texts, axis=1)[:, None] * np.linalg.norm(cats, axis=1))
    assert len(got) == 1_202 and got[None] == got[9_000] == (None, None)
    for i in range(1_200):
        assert abs(got[i][1] - cos[i].max()) < 1e-12 and got[i][0] == ("c7" if i < 20 else f"c{int(cos[i].argmax())}")
