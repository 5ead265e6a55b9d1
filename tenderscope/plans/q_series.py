"""Queries: series preparation and statistics (E), decomposition,
dependence and stationarity (X), forecasts (F, V2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from ..operators.util import rnd

from ..functions.fmt import month_abbr_pt
from ..operators import forecast as fc
from ..operators import series as se
from ..operators import tsa
from ..operators.calendar import month_spine
from ..operators.timeintel import monthly_values
from ..operators.util import join_on_keys
from ..sources.tables import FACT_COLUMNS, fact
from .oracle import FACT_CTE, with_ctes
from .registry import register


def _s0(key=None):
    sid = "'total'" if key is None else f"CAST({key} AS VARCHAR)"
    return f"s0 AS (SELECT {sid} AS series_id, mes, CAST(SUM(valor) AS DOUBLE) AS y FROM fact GROUP BY ALL)"


_GF = """gf AS (SELECT b.series_id, CAST(b.m AS DATE) AS mes, year(b.m) * 12 + month(b.m) AS mseq, s0.y
  FROM (SELECT series_id, unnest(generate_series(MIN(mes), MAX(mes), INTERVAL 1 MONTH)) AS m FROM s0 GROUP BY series_id) b
  LEFT JOIN s0 ON s0.series_id = b.series_id AND s0.mes = CAST(b.m AS DATE))"""

_IP = """ip AS (SELECT series_id, mes, mseq, y,
   LAST_VALUE(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY mseq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
   LAST_VALUE(CASE WHEN y IS NOT NULL THEN mseq END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY mseq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k0,
   FIRST_VALUE(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY mseq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1,
   FIRST_VALUE(CASE WHEN y IS NOT NULL THEN mseq END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY mseq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS k1
  FROM gf),
ipo AS (SELECT series_id, mes, mseq, y,
   CASE WHEN y IS NOT NULL THEN y WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL THEN v0
        ELSE v0 + (v1 - v0) * (mseq - k0) / (k1 - k0) END AS y_interp FROM ip)"""

# E8 + E9 on the interpolated series: July of the first year → median of the other Julys; drop an incomplete last year
_CLEAN = """fy AS (SELECT series_id, year(MIN(mes)) AS y0 FROM ipo GROUP BY 1),
med AS (SELECT i.series_id, median(i.y_interp) AS med FROM ipo i JOIN fy USING (series_id)
        WHERE month(i.mes) = 7 AND year(i.mes) <> fy.y0 GROUP BY 1),
ro AS (SELECT i.series_id, i.mes, i.mseq,
         CASE WHEN month(i.mes) = 7 AND year(i.mes) = fy.y0 AND med.med IS NOT NULL THEN med.med ELSE i.y_interp END AS y
       FROM ipo i JOIN fy USING (series_id) LEFT JOIN med USING (series_id)),
cnt AS (SELECT series_id, year(mes) AS ano, COUNT(*) AS n, MAX(year(mes)) OVER (PARTITION BY series_id) AS ult FROM ro GROUP BY 1, 2),
cl AS (SELECT ro.* FROM ro WHERE NOT EXISTS (SELECT 1 FROM cnt WHERE cnt.series_id = ro.series_id AND cnt.ano = year(ro.mes)
                                              AND cnt.ano = cnt.ult AND cnt.n < 12))"""


def _series_sql(body, key=None, *extra):
    return with_ctes(body, FACT_CTE, _s0(key), *extra)


#: the gap-free, interpolated series
_SX = "sx AS (SELECT series_id, mes, y_interp AS y FROM ipo)"


def _filled_sql(body, key, *extra):
    return _series_sql(body, key, _GF, _IP, _SX, *extra)


def _filled(spark, d, key="categoria_ia"):
    return se.filled(se.series_frame(fact(spark, d), key))


# ---------------------------------------------------------------- E

_FACT_NUMBERS = ("quantidade", "valor")


def _describe_sql(c):
    x = f"CAST({c} AS DOUBLE)" if c in _FACT_NUMBERS else f"TRY_CAST({c} AS DOUBLE)"
    v = x if c in _FACT_NUMBERS else c
    stats = {"count": f"COUNT({c})", "mean": f"AVG({x})", "stddev": f"STDDEV_SAMP({x})", "min": f"MIN({v})", "max": f"MAX({v})"}
    return " UNION ALL ".join(f"SELECT '{s}' AS summary, '{c}' AS coluna, CAST({e} AS VARCHAR) AS t FROM f" for s, e in stats.items())


@register("describe_fact", with_ctes(
    """SELECT summary, coluna, CASE WHEN TRY_CAST(t AS DOUBLE) IS NULL THEN t END AS texto, ROUND(TRY_CAST(t AS DOUBLE), 4) AS numero
       FROM (""" + " UNION ALL ".join(map(_describe_sql, FACT_COLUMNS)) + ") x",
    FACT_CTE, "f AS (SELECT * REPLACE (CAST(mes AS VARCHAR) AS mes) FROM fact)"))
def q_describe_fact(spark, d):
    """Count, mean, stddev, min, max of every column, one row per figure
    (text, or a number where the figure reads as one)."""
    f = fact(spark, d)
    number = lambda t: t in ("tinyint", "smallint", "int", "bigint", "float", "double")
    kind = lambda c, t: F.col(c) if number(t) else F.col(c).cast("double" if t.startswith("decimal") else "string")
    wide = f.select(*[kind(c, t).alias(c) for c, t in f.dtypes]).describe()
    long = wide.unpivot(["summary"], FACT_COLUMNS, "coluna", "t")
    value = F.col("t").try_cast("double")
    return long.select("summary", "coluna", F.when(value.isNull(), F.col("t")).alias("texto"), rnd(value, 4).alias("numero"))


_DESC = """SELECT series_id, COUNT(y) AS count, ROUND(AVG(y), 2) AS mean, ROUND(STDDEV_SAMP(y), 2) AS std, ROUND(MIN(y), 2) AS min,
  ROUND(quantile_cont(y, 0.25), 2) AS p25, ROUND(quantile_cont(y, 0.5), 2) AS p50, ROUND(quantile_cont(y, 0.75), 2) AS p75,
  ROUND(MAX(y), 2) AS max FROM s0 GROUP BY 1"""


@register("describe_monthly_total", _series_sql(_DESC))
def q_describe_monthly_total(spark, d):
    return se.describe(se.series_frame(fact(spark, d)))


@register("describe_by_category", _series_sql(_DESC, "categoria_ia"))
def q_describe_by_category(spark, d):
    return se.describe(se.series_frame(fact(spark, d), "categoria_ia"))


@register("missing_months", _series_sql(
    "SELECT series_id, COUNT(*) AS meses, COUNT(*) FILTER (WHERE y IS NULL) AS meses_faltantes FROM gf GROUP BY 1",
    "codigoItemCompra", _GF))
def q_missing_months(spark, d):
    return se.missing_months(se.series_frame(fact(spark, d), "codigoItemCompra"))


@register("interpolate_linear", _series_sql(
    "SELECT series_id, mes, y, y_interp FROM ipo", "codigoItemCompra", _GF, _IP))
def q_interpolate_linear(spark, d):
    return se.interpolate_linear(se.series_frame(fact(spark, d), "codigoItemCompra")).drop("mseq")


@register("series_summary", _series_sql(
    """SELECT series_id, MIN(mes) AS inicio, MAX(mes) AS fim, COUNT(y_interp) AS observacoes, ROUND(AVG(y_interp), 2) AS media,
         ROUND(STDDEV_SAMP(y_interp), 2) AS desvio, ROUND(STDDEV_SAMP(y_interp) / NULLIF(AVG(y_interp), 0), 6) AS cv
       FROM ipo GROUP BY 1""", "categoria_ia", _GF, _IP))
def q_series_summary(spark, d):
    return se.summary(se.series_frame(fact(spark, d), "categoria_ia"))


@register("month_of_year_means", _series_sql(
    """SELECT m.series_id, CAST(m.mes_ano AS BIGINT) AS mes_ano, ROUND(m.mm, 2) AS media_mes, ROUND(g.g, 2) AS media_geral,
         CAST(g.pico AS BIGINT) AS mes_pico
       FROM (SELECT series_id, month(mes) AS mes_ano, AVG(y_interp) AS mm FROM ipo GROUP BY 1, 2) m
       JOIN (SELECT series_id, AVG(mm) AS g, arg_max(mes_ano, (mm, -mes_ano)) AS pico
             FROM (SELECT series_id, month(mes) AS mes_ano, AVG(y_interp) AS mm FROM ipo GROUP BY 1, 2) x GROUP BY 1) g
       USING (series_id)""", "categoria_ia", _GF, _IP))
def q_month_of_year_means(spark, d):
    return se.month_of_year_means(se.series_frame(fact(spark, d), "categoria_ia"))


@register("box_by_year", _series_sql(
    """SELECT series_id, CAST(ano AS BIGINT) AS ano, ROUND(q1, 2) AS q1, ROUND(mediana, 2) AS mediana, ROUND(q3, 2) AS q3,
         ROUND(MIN(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END), 2) AS bigode_inf,
         ROUND(MAX(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END), 2) AS bigode_sup,
         COUNT(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
       FROM (SELECT i.series_id, year(i.mes) AS ano, i.y_interp AS v, q.q1, q.mediana, q.q3 FROM ipo i
             JOIN (SELECT series_id, year(mes) AS ano, quantile_cont(y_interp, 0.25) AS q1, quantile_cont(y_interp, 0.5) AS mediana,
                          quantile_cont(y_interp, 0.75) AS q3 FROM ipo WHERE y_interp IS NOT NULL GROUP BY 1, 2) q
             ON i.series_id = q.series_id AND year(i.mes) = q.ano WHERE i.y_interp IS NOT NULL) x
       GROUP BY series_id, ano, q1, mediana, q3""", None, _GF, _IP))
def q_box_by_year(spark, d):
    return se.box_by_year(se.series_frame(fact(spark, d)))


@register("replace_outlier", _series_sql("SELECT series_id, mes, ROUND(y, 4) AS y FROM ro", None, _GF, _IP, _CLEAN))
def q_replace_outlier(spark, d):
    r = se.replace_outlier(se.series_frame(fact(spark, d)))
    return r.select("series_id", "mes", rnd("y", 4).alias("y"))


@register("trim_incomplete", _series_sql("SELECT series_id, mes, ROUND(y, 4) AS y FROM cl", None, _GF, _IP, _CLEAN))
def q_trim_incomplete(spark, d):
    c = se.cleaned(fact(spark, d))
    return c.select("series_id", "mes", rnd("y", 4).alias("y"))


@register("first_difference", _series_sql(
    """SELECT series_id, mes, ROUND(dy, 4) AS dy FROM
         (SELECT series_id, mes, y - LAG(y) OVER (PARTITION BY series_id ORDER BY mes) AS dy FROM s0) x WHERE dy IS NOT NULL""",
    "categoria_ia"))
def q_first_difference(spark, d):
    r = se.first_difference(se.series_frame(fact(spark, d), "categoria_ia"))
    return r.select("series_id", "mes", rnd("dy", 4).alias("dy"))


# ---------------------------------------------------------------- X

_DEC = """rn AS (SELECT series_id, mes, y, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY mes) - 1 AS rn,
                COUNT(*) OVER (PARTITION BY series_id) AS n FROM sx WHERE y IS NOT NULL),
tr AS (SELECT series_id, mes, y, rn, n,
         CASE WHEN rn >= 6 AND rn < n - 6 THEN
           (SUM(y) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)
            + SUM(y) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) / 24 END AS trend,
         rn % 12 AS fase FROM rn WHERE n >= 24),
ph AS (SELECT series_id, fase, m - AVG(m) OVER (PARTITION BY series_id) AS seasonal
       FROM (SELECT series_id, fase, AVG(y - trend) AS m FROM tr GROUP BY 1, 2) x),
dec AS (SELECT tr.series_id, tr.mes, tr.y, tr.trend, ph.seasonal, tr.y - tr.trend - ph.seasonal AS resid
        FROM tr JOIN ph ON tr.series_id = ph.series_id AND tr.fase = ph.fase)"""


@register("decompose_additive", _filled_sql(
    "SELECT series_id, mes, ROUND(y, 4) AS y, ROUND(trend, 4) AS trend, ROUND(seasonal, 4) AS seasonal, ROUND(resid, 4) AS resid FROM dec",
    "categoria_ia", _DEC))
def q_decompose_additive(spark, d):
    x = tsa.decompose_additive(_filled(spark, d))
    return x.select("series_id", "mes", *[rnd(c, 4).alias(c) for c in ["y", "trend", "seasonal", "resid"]])


_STR = """st AS (SELECT series_id,
   GREATEST(0, 1 - VAR_POP(resid) / NULLIF(VAR_POP(seasonal + resid), 0)) AS fs,
   GREATEST(0, 1 - VAR_POP(resid) / NULLIF(VAR_POP(trend + resid), 0)) AS ft FROM dec WHERE resid IS NOT NULL GROUP BY 1)"""


@register("strength", _filled_sql("SELECT series_id, ROUND(fs, 6) AS fs, ROUND(ft, 6) AS ft FROM st", "categoria_ia", _DEC, _STR))
def q_strength(spark, d):
    s = tsa.strength(tsa.decompose_additive(_filled(spark, d)))
    return s.select("series_id", rnd("fs", 6).alias("fs"), rnd("ft", 6).alias("ft"))


@register("strength_by_item", _filled_sql(
    "SELECT series_id, ROUND(fs, 6) AS fs, ROUND(ft, 6) AS ft FROM st", "codigoItemCompra", _DEC, _STR))
def q_strength_by_item(spark, d):
    """X2 per item code: series with months missing, so the filled months count."""
    s = tsa.strength(tsa.decompose_additive(_filled(spark, d, "codigoItemCompra")))
    return s.select("series_id", rnd("fs", 6).alias("fs"), rnd("ft", 6).alias("ft"))


def _lvl(c):
    return f"CASE WHEN {c} > 0.64 THEN 'FORTE' WHEN {c} > 0.4 THEN 'MODERADA' ELSE 'FRACA' END"


@register("series_diagnosis", _filled_sql(
    f"""SELECT series_id, ROUND(fs, 6) AS fs, ROUND(ft, 6) AS ft,
          CASE WHEN fs > 0.64 THEN 'FORTE' ELSE 'fraca' END AS stl_fs, CASE WHEN ft > 0.64 THEN 'FORTE' ELSE 'fraca' END AS stl_ft,
          {_lvl('fs')} AS diagnostico_fs, {_lvl('ft')} AS diagnostico_ft,
          CASE WHEN fs > 0.4 THEN 'SARIMA' ELSE 'ARIMA' END AS modelo FROM st""", "categoria_ia", _DEC, _STR))
def q_series_diagnosis(spark, d):
    return tsa.diagnosis(tsa.strength(tsa.decompose_additive(_filled(spark, d))))


_ACF = """c AS (SELECT series_id, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY mes) AS t, y - AVG(y) OVER (PARTITION BY series_id) AS c,
               COUNT(*) OVER (PARTITION BY series_id) AS n FROM {src} WHERE y IS NOT NULL),
ac AS (SELECT a.series_id, b.t - a.t AS lag, SUM(a.c * b.c) AS g, ANY_VALUE(a.n) AS n FROM c a JOIN c b
       ON a.series_id = b.series_id AND b.t - a.t BETWEEN 0 AND {maxlag} GROUP BY 1, 2),
r AS (SELECT series_id, lag, n, g / FIRST_VALUE(g) OVER (PARTITION BY series_id ORDER BY lag) AS r FROM ac)"""


@register("ljung_box", _filled_sql(
    """SELECT series_id, CAST(h AS BIGINT) AS lag, ROUND(q, 4) AS lb_stat,
         ROUND(EXP(-q / 2) * (SELECT SUM(POW(q / 2, j) / factorial(CAST(j AS INTEGER))) FROM range(0, h // 2) t(j)), 6) AS lb_pvalue
       FROM (SELECT series_id, h, ANY_VALUE(n) * (ANY_VALUE(n) + 2) * SUM(r * r / (n - lag)) AS q
             FROM r, (VALUES (12), (24)) hs(h) WHERE lag BETWEEN 1 AND h GROUP BY 1, 2) x""",
    "categoria_ia", _DEC, "rs AS (SELECT series_id, mes, resid AS y FROM dec WHERE resid IS NOT NULL)",
    _ACF.format(src="rs", maxlag="LEAST(24, a.n - 1)")))
def q_ljung_box(spark, d):
    x = tsa.decompose_additive(_filled(spark, d))
    return tsa.ljung_box(x.select("series_id", "mes", "mseq", F.col("resid").alias("y")))


_KPSS = ("""k0 AS (SELECT series_id, y, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY mes) AS t,
                COUNT(*) OVER (PARTITION BY series_id) AS n FROM sx WHERE y IS NOT NULL)""",
         """k1 AS (SELECT k0.series_id, t, n, y - my - b * (t - mt) AS c
         FROM k0 JOIN (SELECT series_id, regr_slope(y, t) AS b, AVG(y) AS my, AVG(t) AS mt FROM k0 GROUP BY 1) f USING (series_id) WHERE n >= 3)""",
         """kg AS (SELECT a.series_id, a.n, z.t - a.t AS k, SUM(a.c * z.c) AS g
         FROM k1 a JOIN k1 z ON a.series_id = z.series_id AND z.t >= a.t GROUP BY ALL)""",
         """kl AS (SELECT series_id, n, SUM(g) FILTER (WHERE k = 0) AS g0, LEAST(FLOOR(1.1447 * POW(POW(
           SUM(CASE WHEN k > 0 THEN k * g * 2 / n ELSE 0 END) / SUM(CASE WHEN k > 0 THEN g * 2 / n ELSE g / n END), 2), 1.0 / 3)
           * POW(n, 1.0 / 3)), n - 1) AS lags
         FROM kg WHERE k <= FLOOR(POW(n, 2.0 / 9)) GROUP BY series_id, n)""",
         """ks AS (SELECT kl.series_id, kl.lags, (ANY_VALUE(g0) + 2 * COALESCE(SUM(g * (1 - k / (lags + 1))) FILTER (WHERE k BETWEEN 1 AND lags), 0)) / ANY_VALUE(kl.n) AS s2
         FROM kl JOIN kg USING (series_id) GROUP BY kl.series_id, kl.lags)""",
         """ke AS (SELECT series_id, SUM(cs * cs) / (ANY_VALUE(n) * ANY_VALUE(n)) AS eta
         FROM (SELECT series_id, n, SUM(c) OVER (PARTITION BY series_id ORDER BY t) AS cs FROM k1) x GROUP BY 1)""",
         "kp AS (SELECT series_id, lags, eta / s2 AS stat FROM ks JOIN ke USING (series_id))",
         """kq AS (SELECT *, CASE WHEN stat <= 0.119 THEN 0.10
             WHEN stat <= 0.146 THEN 0.10 + (stat - 0.119) * (0.05 - 0.10) / (0.146 - 0.119)
             WHEN stat <= 0.176 THEN 0.05 + (stat - 0.146) * (0.025 - 0.05) / (0.176 - 0.146)
             WHEN stat <= 0.216 THEN 0.025 + (stat - 0.176) * (0.01 - 0.025) / (0.216 - 0.176) ELSE 0.01 END AS p FROM kp)""")


@register("kpss_trend", _filled_sql(
    """SELECT series_id, ROUND(stat, 6) AS kpss_stat, ROUND(CAST(p AS DOUBLE), 6) AS kpss_pvalue, CAST(lags AS BIGINT) AS kpss_lags,
         p >= 0.05 AS estacionaria FROM kq""", "categoria_ia", *_KPSS))
def q_kpss_trend(spark, d):
    return tsa.kpss_trend(_filled(spark, d))


_DF = """df0 AS (SELECT series_id, regr_slope(dy, yl) AS b, regr_sxx(dy, yl) AS sxx, regr_syy(dy, yl) AS syy, regr_sxy(dy, yl) AS sxy,
                 regr_count(dy, yl) AS m FROM (SELECT series_id, y AS yl, LEAD(y) OVER (PARTITION BY series_id ORDER BY mes) - y AS dy FROM {src}) x
          WHERE dy IS NOT NULL GROUP BY 1),
{name} AS (SELECT series_id, b / SQRT((syy - sxy * sxy / sxx) / (m - 2) / sxx) AS t, -2.8621 - 2.738 / m - 8.36 / (m * m) AS crit FROM df0)"""


@register("dickey_fuller", _filled_sql(
    """SELECT a.series_id, ROUND(a.t, 6) AS df_stat, ROUND(a.crit, 6) AS df_crit5, a.t < a.crit AS estacionaria,
         ROUND(b.t, 6) AS df_stat_d1, b.t < b.crit AS estacionaria_d1, CAST(CASE WHEN a.t < a.crit THEN 0 ELSE 1 END AS BIGINT) AS d
       FROM t0 a LEFT JOIN t1 b USING (series_id)""", "categoria_ia",
    _DF.format(src="sx", name="t0"),
    "s1 AS (SELECT series_id, mes, y - LAG(y) OVER (PARTITION BY series_id ORDER BY mes) AS y FROM sx)",
    _DF.format(src="(SELECT * FROM s1 WHERE y IS NOT NULL)", name="t1").replace("df0", "df1")))
def q_dickey_fuller(spark, d):
    return tsa.dickey_fuller(_filled(spark, d))


#: the series itself where the test gives d = 0, else its first difference
_SD = """sd AS (SELECT s.series_id, s.mes, CASE WHEN t0.series_id IS NULL OR t0.t < t0.crit THEN s.y ELSE s.dy END AS y
  FROM (SELECT series_id, mes, y, y - LAG(y) OVER (PARTITION BY series_id ORDER BY mes) AS dy FROM sx) s LEFT JOIN t0 USING (series_id))"""


def _acf_sql(body, key, maxlag, *extra):
    return _filled_sql(body, key, _DF.format(src="sx", name="t0"), _SD, _ACF.format(src="sd", maxlag=maxlag), *extra)


@register("acf", _acf_sql(
    """SELECT series_id, CAST(lag AS BIGINT) AS lag, ROUND(r, 6) AS acf, ROUND(1.96 / SQRT(n), 6) AS banda, ROUND(CASE WHEN lag = 0 THEN 0 ELSE 1.96 * SQRT((1 + 2 *
         COALESCE(SUM(CASE WHEN lag > 0 THEN r * r END) OVER (PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS banda_bartlett
       FROM r""",
    "categoria_ia", "LEAST(36, a.n // 2 - 1)"))
def q_acf(spark, d):
    return tsa.acf(tsa.stationary_form(_filled(spark, d)))


# Durbin-Levinson, one lag more per step; r[k + 1] is the autocorrelation at lag k
_PACF = ("rl AS (SELECT series_id, ANY_VALUE(n) AS n, list(r ORDER BY lag) AS r FROM r GROUP BY series_id)",
         """dl AS (SELECT series_id, n, r, 1 AS m, [r[2]] AS phi FROM rl WHERE n // 2 - 1 >= 1
  UNION ALL
  SELECT series_id, n, r, m + 1, list_append([phi[i] - k * phi[m + 1 - i] for i in range(1, m + 1)], k)
  FROM (SELECT *, (r[m + 2] - list_sum([phi[i] * r[m + 2 - i] for i in range(1, m + 1)]))
                  / (1 - list_sum([phi[i] * r[i + 1] for i in range(1, m + 1)])) AS k FROM dl WHERE m < n // 2 - 1) z)""")


@register("pacf", _acf_sql(
    "SELECT series_id, CAST(m AS BIGINT) AS lag, ROUND(phi[m], 6) AS pacf, ROUND(1.96 / SQRT(n), 6) AS banda FROM dl",
    "categoria_ia", "a.n // 2 - 1", *_PACF).replace("WITH ", "WITH RECURSIVE ", 1))
def q_pacf(spark, d):
    return tsa.pacf(tsa.stationary_form(_filled(spark, d)))
