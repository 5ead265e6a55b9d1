"""Queries: the dashboard's linear forecast and interval (F1–F4, V2) and the
study's seasonal forecast with hold-out validation (F5–F9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fmt import month_abbr_pt
from ..operators import forecast as fc
from ..operators import series as se
from ..operators.calendar import month_spine
from ..operators.timeintel import monthly_values
from ..operators.util import rnd
from ..sources.tables import fact
from .oracle import FACT_CTE, with_ctes
from .q_series import _CLEAN, _GF, _IP, _s0
from .registry import register


def _lin_sql(keys=(), sigma=None, z=fc.MODEL_Z):
    k = list(keys)
    kc = "".join(f"{x}, " for x in k)
    kj = lambda a, b: " AND ".join([f"{a}.{x} = {b}.{x}" for x in k]) or "TRUE"
    kg = f"GROUP BY {', '.join(k)}" if k else ""
    sig = "sig.sigma" if sigma is None else repr(float(sigma))
    return f"""
m AS (SELECT {kc}mes, CAST(SUM(valor) AS DOUBLE) AS v FROM fact GROUP BY ALL),
cal AS (SELECT CAST(date_trunc('year', MIN(mes)) AS DATE) AS d0, CAST(MAX(mes) + INTERVAL 7 MONTH AS DATE) AS d1 FROM m),
lst AS (SELECT {kc}MAX(mes) AS last FROM m {kg}),
tr AS (SELECT {''.join(f'lst.{x}, ' for x in k)}CAST(t AS DATE) AS mes
       FROM lst, cal, unnest(generate_series(GREATEST(CAST(lst.last - INTERVAL 12 MONTH AS DATE), cal.d0), lst.last, INTERVAL 1 MONTH)) u(t)),
trv AS (SELECT {''.join(f'tr.{x}, ' for x in k)}tr.mes, CAST(year(tr.mes) * 12 + month(tr.mes) AS DOUBLE) AS x, m.v
        FROM tr LEFT JOIN m ON tr.mes = m.mes AND {kj('tr', 'm')}),
st AS (SELECT {kc}x, v, AVG(x) OVER ({'PARTITION BY ' + ', '.join(k) if k else ''}) AS mx,
              AVG(v) OVER ({'PARTITION BY ' + ', '.join(k) if k else ''}) AS my FROM trv),
fit AS (SELECT {kc}SUM((x - mx) * (COALESCE(v, 0) - my)) AS sxy, SUM((x - mx) * (x - mx)) AS sxx,
               ANY_VALUE(mx) AS mx, ANY_VALUE(my) AS my, COUNT(*) AS k FROM st {kg}),
co AS (SELECT {kc}sxy / NULLIF(sxx, 0) AS slope, my - sxy / NULLIF(sxx, 0) * mx AS icpt, k FROM fit),
sig AS (SELECT {''.join(f'trv.{x}, ' for x in k)}SQRT(SUM(POW(COALESCE(trv.v, 0) - (co.icpt + co.slope * trv.x), 2)) / (ANY_VALUE(co.k) - 2)) AS sigma
        FROM trv JOIN co ON {kj('trv', 'co')} {('GROUP BY ' + ', '.join('trv.' + x for x in k)) if k else ''}),
hz AS (SELECT {''.join(f'lst.{x}, ' for x in k)}CAST(t AS DATE) AS mes
       FROM lst, cal, unnest(generate_series(lst.last, CAST(date_trunc('month', cal.d1) AS DATE), INTERVAL 1 MONTH)) u(t)),
pv AS (SELECT {''.join(f'hz.{x}, ' for x in k)}hz.mes, year(hz.mes) * 12 + month(hz.mes) AS mseq, m.v,
              GREATEST(0, co.icpt + co.slope * (year(hz.mes) * 12 + month(hz.mes))) AS f, {sig} AS sigma
       FROM hz JOIN co ON {kj('hz', 'co')} JOIN sig ON {kj('hz', 'sig')} LEFT JOIN m ON hz.mes = m.mes AND {kj('hz', 'm')}),
pvi AS (SELECT *, CASE WHEN f IS NOT NULL AND f <> 0 THEN f + {z} * sigma END AS up,
               CASE WHEN f IS NOT NULL AND f <> 0 THEN GREATEST(0, f - {z} * sigma) END AS lo FROM pv)"""


def _lin_out(keys=(), places=2):
    kc = "".join(f"{x}, " for x in keys)
    return (f"SELECT {kc}mes, CAST(mseq AS BIGINT) AS mseq, ROUND(v, 2) AS valor_total, ROUND(f, {places}) AS valor_previsto,"
            f" ROUND(up, {places}) AS ic_superior, ROUND(lo, {places}) AS ic_inferior FROM pvi")


def _lin_spark(fcst, keys=(), places=2):
    return fcst.select(*keys, "mes", F.col("mseq").cast("bigint").alias("mseq"), rnd("valor_total", 2).alias("valor_total"),
                       rnd("valor_previsto", places).alias("valor_previsto"), rnd("ic_superior", places).alias("ic_superior"),
                       rnd("ic_inferior", places).alias("ic_inferior"))


@register("forecast_ols", with_ctes(_lin_out(), FACT_CTE, _lin_sql(sigma=fc.MODEL_SIGMA)))
def q_forecast_ols(spark, d):
    return _lin_spark(fc.with_interval(fc.linear_forecast(fact(spark, d))))


@register("forecast_interval", with_ctes(_lin_out(), FACT_CTE, _lin_sql(sigma=None)))
def q_forecast_interval(spark, d):
    # sigma = the fit's residual standard error instead of the model constant
    return _lin_spark(fc.with_interval(fc.linear_forecast(fact(spark, d)), sigma=None))


@register("forecast_by_category", with_ctes(_lin_out(["categoria_ia"]), FACT_CTE, _lin_sql(["categoria_ia"], sigma=fc.MODEL_SIGMA)))
def q_forecast_by_category(spark, d):
    return _lin_spark(fc.with_interval(fc.linear_forecast(fact(spark, d), ["categoria_ia"])), ["categoria_ia"])


@register("forecast_by_supplier", with_ctes(_lin_out(["nome"], 0), FACT_CTE, _lin_sql(["nome"], sigma=fc.MODEL_SIGMA)))
def q_forecast_by_supplier(spark, d):
    """F4 per supplier, in whole units: the last bits of the fits differ by engine."""
    return _lin_spark(fc.with_interval(fc.linear_forecast(fact(spark, d), ["nome"])), ["nome"], 0)


_ABBR = "(['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'])"


@register("evolution_line", with_ctes(
    f"""SELECT {_ABBR}[month(s.mes)] || '/' || CAST(year(s.mes) AS VARCHAR) AS mes_ano,
          CAST(year(s.mes) * 100 + month(s.mes) AS BIGINT) AS mes_ano_numero, ROUND(m.v, 2) AS valor_total,
          ROUND(pvi.f, 2) AS valor_previsto, ROUND(pvi.up, 2) AS ic_superior, ROUND(pvi.lo, 2) AS ic_inferior
        FROM (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS mes FROM cal) s
        LEFT JOIN m ON s.mes = m.mes LEFT JOIN pvi ON s.mes = pvi.mes""", FACT_CTE, _lin_sql(sigma=fc.MODEL_SIGMA)))
def q_evolution_line(spark, d):
    f = fact(spark, d)
    m = monthly_values(f).withColumn("v", F.col("v").cast("double"))
    spine = month_spine(m)
    p = fc.with_interval(fc.linear_forecast(f), sigma=fc.MODEL_SIGMA).select("mes", "valor_previsto", "ic_superior", "ic_inferior")
    j = spine.join(m, on="mes", how="left").join(p, on="mes", how="left")
    return j.select(
        F.concat(month_abbr_pt(F.month("mes")), F.lit("/"), F.year("mes").cast("string")).alias("mes_ano"),
        (F.year("mes") * 100 + F.month("mes")).cast("bigint").alias("mes_ano_numero"),
        rnd("v", 2).alias("valor_total"), rnd("valor_previsto", 2).alias("valor_previsto"),
        rnd("ic_superior", 2).alias("ic_superior"), rnd("ic_inferior", 2).alias("ic_inferior"))


# ---------------------------------------------------------------- F5–F9 (cleaned series per category)

_SPLIT = """sp AS (SELECT cl.*, CASE WHEN cl.mes <= make_date(year(x.last) - 1, 12, 1) THEN 'treino' ELSE 'teste' END AS conjunto
        FROM cl JOIN (SELECT series_id, MAX(mes) AS last FROM cl GROUP BY 1) x USING (series_id))"""

_FIT = """{p}t AS (SELECT series_id, mes, y, CAST(year(mes) * 12 + month(mes) AS DOUBLE) AS x FROM {src}),
{p}tb AS (SELECT series_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {p}t GROUP BY 1),
{p}tt AS (SELECT {p}t.*, {p}tb.a + {p}tb.b * {p}t.x AS tr FROM {p}t JOIN {p}tb USING (series_id)),
{p}ix0 AS (SELECT series_id, month(mes) AS moy, AVG(y / NULLIF(tr, 0)) AS i FROM {p}tt GROUP BY 1, 2),
{p}ix AS (SELECT series_id, moy, i / AVG(i) OVER (PARTITION BY series_id) AS idx FROM {p}ix0),
{p}sd AS (SELECT {p}tt.series_id, STDDEV_SAMP({p}tt.y - {p}tt.tr * {p}ix.idx) AS sd FROM {p}tt
          JOIN {p}ix ON {p}tt.series_id = {p}ix.series_id AND month({p}tt.mes) = {p}ix.moy GROUP BY 1)"""

_APPLY = """SELECT q.series_id, q.mes, ROUND(q.y, 2) AS y{extra_sel}, ROUND(yh, 2) AS yhat, ROUND(yh - 1.645 * sd, 2) AS yhat_lower,
       ROUND(yh + 1.645 * sd, 2) AS yhat_upper
FROM (SELECT r.*, (b.a + b.b * (year(r.mes) * 12 + month(r.mes))) * ix.idx AS yh, s.sd
      FROM {rows} r JOIN {p}tb b USING (series_id) JOIN {p}sd s USING (series_id)
      LEFT JOIN {p}ix ix ON r.series_id = ix.series_id AND month(r.mes) = ix.moy) q"""

_CL = (FACT_CTE, _s0("categoria_ia"), _GF, _IP, _CLEAN)


def _round_pred(df, extra=()):
    return df.select("series_id", "mes", rnd("y", 2).alias("y"), *extra, rnd("yhat", 2).alias("yhat"),
                     rnd("yhat_lower", 2).alias("yhat_lower"), rnd("yhat_upper", 2).alias("yhat_upper"))


@register("train_test_split", with_ctes("SELECT series_id, mes, ROUND(y, 4) AS y, conjunto FROM sp", *_CL, _SPLIT))
def q_train_test_split(spark, d):
    s = fc.train_test(se.cleaned(fact(spark, d), "categoria_ia"))
    return s.select("series_id", "mes", rnd("y", 4).alias("y"), "conjunto")


_VAL = with_ctes(_APPLY.format(rows="(SELECT series_id, mes, y FROM sp WHERE conjunto = 'teste')", p="v", extra_sel=""),
                 *_CL, _SPLIT, _FIT.format(p="v", src="(SELECT * FROM sp WHERE conjunto = 'treino')"))


@register("forecast_seasonal", _VAL)
def q_forecast_seasonal(spark, d):
    return _round_pred(fc.seasonal_validation(fc.train_test(se.cleaned(fact(spark, d), "categoria_ia"))))


@register("forecast_metrics", with_ctes(
    """SELECT series_id, ROUND(AVG(ABS(y - yhat) / ABS(y)) * 100, 4) AS mape, ROUND(AVG(ABS(y - yhat)), 2) AS mae,
         ROUND(SQRT(AVG(POW(y - yhat, 2))), 2) AS rmse,
         CASE WHEN AVG(ABS(y - yhat) / ABS(y)) * 100 < 20 THEN 'BOA' WHEN AVG(ABS(y - yhat) / ABS(y)) * 100 < 35 THEN 'RAZOÁVEL'
              ELSE 'LIMITADA' END AS acuracia
       FROM (""" + _APPLY.format(rows="(SELECT series_id, mes, y FROM sp WHERE conjunto = 'teste')", p="v", extra_sel="")
    .replace("ROUND(q.y, 2) AS y", "q.y AS y").replace("ROUND(yh, 2) AS yhat", "yh AS yhat") + ") pr WHERE y IS NOT NULL GROUP BY 1",
    *_CL, _SPLIT, _FIT.format(p="v", src="(SELECT * FROM sp WHERE conjunto = 'treino')")))
def q_forecast_metrics(spark, d):
    return fc.metrics(fc.seasonal_validation(fc.train_test(se.cleaned(fact(spark, d), "categoria_ia"))))


_FUT = """fut AS (SELECT series_id, mes, y, 'ajuste' AS tipo FROM cl
        UNION ALL
        SELECT series_id, CAST(t AS DATE) AS mes, CAST(NULL AS DOUBLE) AS y, 'previsao' AS tipo
        FROM (SELECT series_id, MAX(mes) AS last FROM cl GROUP BY 1) l,
             unnest(generate_series(CAST(l.last + INTERVAL 1 MONTH AS DATE), CAST(l.last + INTERVAL 12 MONTH AS DATE), INTERVAL 1 MONTH)) u(t))"""


@register("forecast_with_history", with_ctes(
    _APPLY.format(rows="fut", p="w", extra_sel=", q.tipo"), *_CL, _FIT.format(p="w", src="cl"), _FUT))
def q_forecast_with_history(spark, d):
    return _round_pred(fc.seasonal_future(se.cleaned(fact(spark, d), "categoria_ia")), ["tipo"])
