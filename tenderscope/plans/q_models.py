"""Queries: robust decomposition (X2–X4), augmented Dickey-Fuller (X9), movable
feasts and the change-point forecast (F6–F9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import adf as ad
from ..operators import changepoints as cp
from ..operators import forecast as fc
from ..operators import series as se
from ..operators import stl as st
from ..operators import tsa
from ..operators.calendar import FEASTS, easter
from ..operators.util import money, rnd
from ..sources.tables import fact
from .oracle import FACT_CTE, money as smoney, with_ctes
from .q_forecast import _CL, _SPLIT
from .q_series import _GF, _IP, _SX, _filled, _s0
from .registry import register

# ---------------------------------------------------------------- STL (no SQL form: the tests compare it with NumPy)


def _stl(spark, d, key):
    return st.stl(_filled(spark, d, key))


@register("stl_components")
def q_stl_components(spark, d):
    """Robust trend, season and remainder of every category's series."""
    x = _stl(spark, d, "categoria_ia")
    return x.select("series_id", F.col("rn").cast("bigint").alias("rn"), *[rnd(c, 4).alias(c) for c in ("y", "trend", "seasonal", "resid")])


@register("stl_diagnosis")
def q_stl_diagnosis(spark, d):
    """X2–X4 on the robust decomposition, per category."""
    return tsa.diagnosis(tsa.strength(_stl(spark, d, "categoria_ia")))


@register("stl_strength_by_supplier")
def q_stl_strength_by_supplier(spark, d):
    s = tsa.strength(_stl(spark, d, "nome"))
    return s.select("series_id", rnd("fs", 6).alias("fs"), rnd("ft", 6).alias("ft"))


# ---------------------------------------------------------------- augmented Dickey-Fuller

def _standard(cols: str) -> str:
    """Columns centred and scaled to length one."""
    length = "sqrt(list_sum([(u - list_avg(c)) * (u - list_avg(c)) for u in c]))"
    return f"[CASE WHEN {length} > 0 THEN [(v - list_avg(c)) / {length} for v in c] ELSE [0.0 for v in c] END for c in {cols}]"


def _swept(p: str, m: str) -> str:
    return (f"[CASE WHEN i <= {p} THEN a[i] ELSE [a[i][j] - a[i][{p}] * a[{p}][j] / nullif(a[{p}][{p}], 0) for j in range(1, {m} + 1)] END"
            f" for i in range(1, {m} + 1)]")


def _adf_ctes():
    z = f"CASE WHEN stat <= {ad.TURN} THEN {ad.polynomial(ad.SMALL, 'stat')} ELSE {ad.polynomial(ad.LARGE, 'stat')} END".replace("D)", ")")
    series = ("list_sum([sign(z) * exp((2 * k + 1) * ln(abs(z)) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi())) for k in range(0, 201)])")
    return (
        "ar AS (SELECT series_id, list(y ORDER BY mes) AS ys FROM sx WHERE y IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 4)",
        """src AS (SELECT series_id, 0 AS kind, ys FROM ar UNION ALL
          SELECT series_id, 1, [ys[i + 1] - ys[i] for i in range(1, len(ys))] FROM ar)""",
        """dif AS (SELECT *, [ys[i + 1] - ys[i] for i in range(1, len(ys))] AS dx,
                 CAST(least(ceil(12 * pow(len(ys) / 100.0, 0.25)), len(ys) // 2 - 2) AS INT) AS mx FROM src)""",
        """wide AS (SELECT *, list_concat([ys[mx + 1:len(dx)]], list_concat([dx[mx - l + 1:len(dx) - l] for l in range(1, mx + 1)], [dx[mx + 1:len(dx)]])) AS cols
                 FROM dif WHERE mx >= 0)""",
        f"wz AS (SELECT * EXCLUDE (cols), {_standard('cols')} AS z FROM wide)",
        "wa AS (SELECT * EXCLUDE (z), [[list_dot_product(u, v) for v in z] for u in z] AS a FROM wz)",
        f"""sw AS (SELECT series_id, kind, mx, len(dx) AS nd, 0 AS k, a, CAST([] AS DOUBLE[]) AS ssr FROM wa
          UNION ALL
          SELECT series_id, kind, mx, nd, k + 1, b, list_append(ssr, b[mx + 2][mx + 2])
          FROM (SELECT *, {_swept('(k + 1)', '(mx + 2)')} AS b FROM sw WHERE k <= mx) x)""",
        """aic AS (SELECT series_id, kind, p - 1 AS p, (nd - mx) * ln(ssr[p] / (nd - mx)) + 2 * (p + 1) AS aic
          FROM (SELECT *, unnest(range(1, mx + 2)) AS p FROM sw WHERE k = mx + 1) x WHERE ssr[p] > 0)""",
        "best AS (SELECT series_id, kind, arg_min(p, (aic, p)) AS p FROM aic GROUP BY 1, 2)",
        """nar AS (SELECT series_id, kind, CAST(p AS INT) AS p, len(dx) - p AS nobs,
          list_concat([dx[p - l + 1:len(dx) - l] for l in range(1, p + 1)], [ys[p + 1:len(dx)], dx[p + 1:len(dx)]]) AS cols
          FROM dif JOIN best USING (series_id, kind))""",
        f"nz AS (SELECT * EXCLUDE (cols), {_standard('cols')} AS z FROM nar)",
        "na AS (SELECT * EXCLUDE (z), [[list_dot_product(u, v) for v in z] for u in z] AS a FROM nz)",
        f"""ns AS (SELECT series_id, kind, p, nobs, 0 AS k, a FROM na
          UNION ALL SELECT series_id, kind, p, nobs, k + 1, {_swept('(k + 1)', '(p + 2)')} FROM ns WHERE k < p)""",
        """tt AS (SELECT series_id, kind, p, nobs, a[p + 1][p + 2] / a[p + 1][p + 1]
            / sqrt((a[p + 2][p + 2] - a[p + 1][p + 2] * a[p + 1][p + 2] / a[p + 1][p + 1]) / (nobs - p - 2) / a[p + 1][p + 1]) AS stat
          FROM ns WHERE k = p)""",
        f"""pv AS (SELECT *, CASE WHEN stat > {ad.MOST} THEN 1 WHEN stat < {ad.LEAST} THEN 0 WHEN z < -8 THEN 0 WHEN z > 8 THEN 1
            ELSE 0.5 + exp(-z * z / 2) / sqrt(2 * pi()) * {series} END AS pval FROM (SELECT *, {z} AS z FROM tt) x)""")


@register("augmented_dickey_fuller", with_ctes(
    "SELECT a.series_id, ROUND(a.stat, 4) AS adf_stat, CAST(a.p AS BIGINT) AS adf_lags, CAST(a.nobs AS BIGINT) AS adf_nobs, ROUND(a.pval, 4) AS adf_pvalue, "
    + ", ".join(f"ROUND({ad.polynomial(c, '(1.0 / a.nobs)')}, 4) AS adf_crit{k}".replace("D)", ")") for k, c in ad.CRITICAL.items())
    + f""", a.pval < {ad.LEVEL} AS estacionaria, ROUND(b.stat, 4) AS adf_stat_d1, ROUND(b.pval, 4) AS adf_pvalue_d1,
         CAST(CASE WHEN a.pval < {ad.LEVEL} THEN 0 ELSE 1 END AS BIGINT) AS d
       FROM (SELECT * FROM pv WHERE kind = 0) a LEFT JOIN (SELECT * FROM pv WHERE kind = 1) b ON a.series_id = b.series_id""",
    FACT_CTE, _s0("categoria_ia"), _GF, _IP, _SX, *_adf_ctes()).replace("WITH ", "WITH RECURSIVE ", 1))
def q_augmented_dickey_fuller(spark, d):
    """Lag by AIC, p-value, order of integration, per category."""
    r = ad.augmented_dickey_fuller(_filled(spark, d))
    return r.select(*[rnd(c, 4).alias(c) if t == "double" else F.col(c) for c, t in r.dtypes])


# ---------------------------------------------------------------- feasts

_FEAST_SQL = " UNION ALL ".join(
    f"SELECT CAST(ano AS BIGINT) AS ano, '{name}' AS feriado, {easter('ano', '//')} + CAST({day} AS INT) AS dia FROM yy" for name, days in FEASTS.items() for day in days)


@register("feast_months", with_ctes(
    f"""SELECT f.ano, f.feriado, f.dia, {smoney('SUM(fact.valor)')} AS valor_mes FROM fe f
        LEFT JOIN fact ON fact.mes = CAST(date_trunc('month', f.dia) AS DATE) GROUP BY 1, 2, 3""",
    FACT_CTE, "yy AS (SELECT DISTINCT year(mes) AS ano FROM fact)", f"fe AS ({_FEAST_SQL})"))
def q_feast_months(spark, d):
    """Movable feasts of the fact's years, with the value of their month."""
    f = fact(spark, d)
    months = f.groupBy("mes").agg(F.sum("valor").alias("v"))
    days = F.array(*[F.struct(F.lit(name).alias("feriado"), F.lit(day).alias("n")) for name, ds in FEASTS.items() for day in ds])
    e = months.select(F.year("mes").alias("ano")).distinct().withColumn("pascoa", F.expr(easter("ano")))
    e = e.select("ano", "pascoa", F.explode(days).alias("q")).select(F.col("ano").cast("bigint").alias("ano"), "q.feriado", F.expr("date_add(pascoa, q.n)").alias("dia"))
    return e.join(months, F.trunc("dia", "MM") == F.col("mes"), "left").select("ano", "feriado", "dia", money("v").alias("valor_mes"))


# ---------------------------------------------------------------- change-point forecast


def _cp_ctes(src: str, rows: str):
    season = "[" + ", ".join(cp.seasonal_terms("month(mes)", "year(mes)", "//")) + "]"
    row = lambda t, s: (f"list_concat(list_concat([1.0, {t}], [greatest({t} - c, 0) for c in bends]), [(line_a + line_b * {t}) * v for v in {s}])")
    tail = (1 - cp.INTERVAL) / 2
    return (
        f"""c0 AS (SELECT series_id, list(year(mes) * 12 + month(mes) ORDER BY mes) AS xs, list(y ORDER BY mes) AS yv, list({season} ORDER BY mes) AS sv,
              MAX(abs(y)) AS top, COUNT(*) AS n FROM {src} WHERE y IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 6 AND MAX(abs(y)) > 0)""",
        """c1 AS (SELECT series_id, top, n, sv, xs[1] AS x0, CAST(xs[n] - xs[1] AS DOUBLE) AS span, [(x - xs[1]) / CAST(xs[n] - xs[1] AS DOUBLE) for x in xs] AS t,
              [v / top for v in yv] AS ys, CAST(floor(n * 0.8) AS INT) - 1 AS la FROM c0)""",
        """c2 AS (SELECT *, least(25, la) AS cn, list_avg(t) AS mt, list_avg(ys) AS my FROM c1)""",
        """c3 AS (SELECT *, list_sum([(t[i] - mt) * (ys[i] - my) for i in range(1, n + 1)]) / list_sum([(u - mt) * (u - mt) for u in t]) AS line_b,
              [t[CAST(round_even(k * la / CAST(cn AS DOUBLE), 0) AS INT) + 1] for k in range(1, cn + 1)] AS bends FROM c2)""",
        "c4 AS (SELECT *, my - line_b * mt AS line_a FROM c3)",
        f"c5 AS (SELECT *, [{row('t[q]', 'sv[q]')} for q in range(1, n + 1)] AS f FROM c4)",
        "c6 AS (SELECT *, len(f[1]) AS m, [[r[i] for r in f] for i in range(1, len(f[1]) + 1)] AS fc FROM c5)",
        f"""c7 AS (SELECT series_id, m, 0 AS k, [list_append([list_dot_product(fc[i], fc[j]) + CASE WHEN i <> j OR i < 3 THEN 0
              WHEN i < 3 + len(bends) THEN {cp.CHANGE_PENALTY} ELSE {cp.SEASON_PENALTY} END for j in range(1, m + 1)], list_dot_product(fc[i], ys))
              for i in range(1, m + 1)] AS a FROM c6)""",
        """gj AS (SELECT * FROM c7 UNION ALL
          SELECT series_id, m, k + 1, [CASE WHEN i = k + 1 THEN r ELSE [a[i][j] - a[i][k + 1] * r[j] for j in range(1, m + 2)] END for i in range(1, m + 1)]
          FROM (SELECT *, [v / a[k + 1][k + 1] for v in a[k + 1]] AS r FROM gj WHERE k < m) x)""",
        "ww AS (SELECT series_id, [r[m + 1] for r in a] AS w FROM gj WHERE k = m)",
        f"""md AS (SELECT *, quantile_cont(e, {tail}) OVER (PARTITION BY series_id) AS lo, quantile_cont(e, {1 - tail}) OVER (PARTITION BY series_id) AS hi
          FROM (SELECT c6.series_id, x0, span, top, line_a, line_b, bends, w,
                unnest([ys[q] - list_dot_product(f[q], w) for q in range(1, n + 1)]) AS e FROM c6 JOIN ww USING (series_id)) x)""",
        "mm AS (SELECT DISTINCT series_id, x0, span, top, line_a, line_b, bends, w, lo, hi FROM md)",
        f"""ph AS (SELECT r.*, list_dot_product({row('t1', 's1')}, w) AS yh, lo, hi, top
          FROM (SELECT *, (year(mes) * 12 + month(mes) - x0) / span AS t1, {season} AS s1 FROM ({rows}) q JOIN mm USING (series_id)) r)""")


_PRED = """ROUND(y / 1e3, 2) AS y_mil, ROUND(yh * top / 1e3, 2) AS yhat_mil, ROUND((yh + lo) * top / 1e3, 2) AS yhat_lower_mil,
   ROUND((yh + hi) * top / 1e3, 2) AS yhat_upper_mil"""


def _thousands(df, *extra):
    """Forecasts in thousands: the last bits of the fits differ by engine."""
    return df.select("series_id", "mes", *extra, rnd(F.col("y") / 1e3, 2).alias("y_mil"), rnd(F.col("yhat") / 1e3, 2).alias("yhat_mil"),
                     rnd(F.col("yhat_lower") / 1e3, 2).alias("yhat_lower_mil"), rnd(F.col("yhat_upper") / 1e3, 2).alias("yhat_upper_mil"))


@register("forecast_changepoint", with_ctes(
    f"SELECT series_id, mes, {_PRED} FROM ph", *_CL, _SPLIT,
    *_cp_ctes("(SELECT * FROM sp WHERE conjunto = 'treino')", "SELECT series_id, mes, y FROM sp WHERE conjunto = 'teste'")
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_forecast_changepoint(spark, d):
    """F6 (validation): trend with change points, season and movable feasts, per category."""
    return _thousands(cp.validation(fc.train_test(se.cleaned(fact(spark, d), "categoria_ia"))))


@register("forecast_changepoint_future", with_ctes(
    f"SELECT series_id, mes, tipo, {_PRED} FROM ph", *_CL,
    *_cp_ctes("cl", """SELECT series_id, mes, y, 'ajuste' AS tipo FROM cl UNION ALL
        SELECT series_id, CAST(t AS DATE) AS mes, CAST(NULL AS DOUBLE) AS y, 'previsao' AS tipo FROM (SELECT series_id, MAX(mes) AS last FROM cl GROUP BY 1) l,
             unnest(generate_series(CAST(l.last + INTERVAL 1 MONTH AS DATE), CAST(l.last + INTERVAL 12 MONTH AS DATE), INTERVAL 1 MONTH)) u(t)""")
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_forecast_changepoint_future(spark, d):
    """F6 (final), F9: the fit beside the next twelve months."""
    return _thousands(cp.future(se.cleaned(fact(spark, d), "categoria_ia")), "tipo")


@register("forecast_changepoint_metrics", with_ctes(
    """SELECT series_id, ROUND(AVG(ABS(y - yh * top) / ABS(y)) * 100, 3) AS mape, ROUND(AVG(ABS(y - yh * top)) / 1e3, 2) AS mae_mil,
         ROUND(SQRT(AVG(POW(y - yh * top, 2))) / 1e3, 2) AS rmse_mil,
         CASE WHEN AVG(ABS(y - yh * top) / ABS(y)) * 100 < 20 THEN 'BOA' WHEN AVG(ABS(y - yh * top) / ABS(y)) * 100 < 35 THEN 'RAZOÁVEL' ELSE 'LIMITADA' END AS acuracia
       FROM ph WHERE y IS NOT NULL GROUP BY 1""", *_CL, _SPLIT,
    *_cp_ctes("(SELECT * FROM sp WHERE conjunto = 'treino')", "SELECT series_id, mes, y FROM sp WHERE conjunto = 'teste'")
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_forecast_changepoint_metrics(spark, d):
    """F7, F8 of the change-point forecast."""
    m = fc.raw_metrics(cp.validation(fc.train_test(se.cleaned(fact(spark, d), "categoria_ia"))))
    return m.select("series_id", rnd("mape", 3).alias("mape"), rnd(F.col("mae") / 1e3, 2).alias("mae_mil"), rnd(F.col("rmse") / 1e3, 2).alias("rmse_mil"), "acuracia")
