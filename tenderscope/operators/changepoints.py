"""Forecast with a bending trend, a yearly season and movable feasts.

The trend is piecewise linear with up to ``CHANGES`` bends spread over the first
four fifths of the history; the season is the yearly Fourier basis plus the
days of Carnival, Good Friday and Corpus Christi in the month, both in proportion
to the level (a straight line through the series), as a multiplicative season
is.  Bends and season are held back by fixed ridge penalties.  Each series is
solved in its own row: the months in an array, the normal equations and their
elimination as one expression, a few dozen columns wide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calendar import feast_days
from .series import sorted_quantile
from .tsa import let
from .util import month_seq

# Fixed values of the study's model: bends, the share of the history that may
# bend, width of the interval; penalties stand for its prior scales.
CHANGES, HISTORY, INTERVAL = 25, 0.8, 0.9
CHANGE_PENALTY, SEASON_PENALTY = 0.3, 0.001
ORDER = 5


def seasonal_terms(month, year, quotient: str = "div") -> list[str]:
    """SQL terms of a month: yearly sines and cosines, and days of movable feasts."""
    angle = f"(2 * pi() * ({month} - 1) / 12)"
    waves = [f"{f}({k} * {angle})" for k in range(1, ORDER + 1) for f in ("sin", "cos")] + [f"cos({ORDER + 1} * {angle})"]
    return waves + [f"cast({days} as double)" for days in feast_days(month, year, quotient).values()]


def _dot(a: str, b: str) -> str:
    return f"aggregate(sequence(0, size({a}) - 1), 0D, (s, i) -> s + {a}[i] * {b}[i])"


def _solve(a: str) -> str:
    """Solution of the symmetric positive system ``a`` (last column: right side) by elimination."""
    step = let(f"transform(m[k], v -> v / m[k][k])", "r", "transform(m, (row, i) -> if(i = k, r, transform(row, (v, j) -> v - row[k] * r[j])))")
    return f"transform(aggregate(sequence(0, size({a}) - 1), {a}, (m, k) -> {step}), row -> row[size(row) - 1])"


def _line(p: str) -> str:
    """Intercept and slope of y on place (0 to 1) through the points ``p`` (t, y)."""
    mean = lambda c: f"aggregate({p}, 0D, (s, x) -> s + x.{c}) / size({p})"
    sxy = f"aggregate({p}, 0D, (s, x) -> s + (x.t - c0.mt) * (x.y - c0.my))"
    sxx = f"aggregate({p}, 0D, (s, x) -> s + (x.t - c0.mt) * (x.t - c0.mt))"
    return let(f"named_struct('mt', {mean('t')}, 'my', {mean('y')})", "c0", let(f"{sxy} / {sxx}", "b0", "named_struct('a', c0.my - b0 * c0.mt, 'b', b0)"))


def _row(t: str, season: str) -> str:
    return (f"concat(array(1D, {t}), transform(bends, c -> greatest({t} - c, 0D)), "
            f"transform({season}, v -> (line.a + line.b * {t}) * v))")


def fit(series: DataFrame) -> DataFrame:
    """Per series (six months at least): ``x0`` and ``span`` of the time axis, ``top`` (scale
    of y), ``line``, ``bends``, weights ``w`` and the residuals' quantiles ``lo``, ``hi``."""
    s = series.where(F.col("y").isNotNull()).select("series_id", month_seq("mes").alias("x"), "y",
                                                    F.expr(f"array({', '.join(seasonal_terms('month(mes)', 'year(mes)'))})").alias("season"))
    p = s.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("x", "y", "season"))).alias("p")).where(F.size("p") >= 6)
    p = p.select("series_id", "p", F.expr("p[0].x").alias("x0"), F.expr("cast(p[size(p) - 1].x - p[0].x as double)").alias("span"),
                 F.expr("aggregate(p, 0D, (s, q) -> greatest(s, abs(q.y)))").alias("top")).where("top > 0")
    p = p.withColumn("p", F.expr("transform(p, q -> named_struct('t', (q.x - x0) / span, 'y', q.y / top, 'season', q.season))"))
    last = f"cast(floor(size(p) * {HISTORY}D) as int) - 1"
    bends = let(last, "la", let(f"least({CHANGES}, la)", "cn", "transform(sequence(1, cn), k -> p[cast(bround(k * la / cast(cn as double)) as int)].t)"))
    p = p.withColumn("line", F.expr(_line("p"))).withColumn("bends", F.expr(bends))
    p = p.withColumn("f", F.expr(f"transform(p, q -> {_row('q.t', 'q.season')})"))
    penalty = f"if(i <> j or i < 2, 0D, if(i < 2 + size(bends), {CHANGE_PENALTY}D, {SEASON_PENALTY}D))"
    system = (f"transform(sequence(0, size(f[0]) - 1), i -> concat(transform(sequence(0, size(f[0]) - 1), j -> "
              f"aggregate(f, 0D, (s, r) -> s + r[i] * r[j]) + {penalty}), "
              "array(aggregate(sequence(0, size(p) - 1), 0D, (s, q) -> s + f[q][i] * p[q].y))))")
    p = p.withColumn("w", F.expr(let(system, "a", _solve("a"))))
    left = f"array_sort(transform(p, (q, n) -> q.y - {let('f[n]', 'fr', _dot('fr', 'w'))}))"
    p = p.withColumn("left", F.expr(left))
    tail = (1 - INTERVAL) / 2
    return p.select("series_id", "x0", "span", "top", "line", "bends", "w",
                    sorted_quantile("left", tail).alias("lo"), sorted_quantile("left", 1 - tail).alias("hi"))


def predict(model: DataFrame, months: DataFrame) -> DataFrame:
    """``months`` (series_id, mes, …) with ``yhat``, ``yhat_lower``, ``yhat_upper``."""
    m = months.withColumn("_season", F.expr(f"array({', '.join(seasonal_terms('month(mes)', 'year(mes)'))})"))
    j = m.join(model, on="series_id").withColumn("_t", (month_seq("mes") - F.col("x0")) / F.col("span"))
    j = j.withColumn("_f", F.expr(_row("_t", "_season"))).withColumn("_yh", F.expr(_dot("_f", "w")))
    return j.select(*months.columns, (F.col("_yh") * F.col("top")).alias("yhat"), ((F.col("_yh") + F.col("lo")) * F.col("top")).alias("yhat_lower"),
                    ((F.col("_yh") + F.col("hi")) * F.col("top")).alias("yhat_upper"))


def validation(split: DataFrame) -> DataFrame:
    """F6 (validation): fit on ``treino`` rows, predict the ``teste`` rows."""
    return predict(fit(split.where("conjunto = 'treino'")), split.where("conjunto = 'teste'").select("series_id", "mes", "y"))


def future(series: DataFrame, horizon: int = 12) -> DataFrame:
    """F6 (final) and F9: fit on all rows; the fit beside ``horizon`` months to come, flagged ``ajuste`` / ``previsao``."""
    ahead = series.groupBy("series_id").agg(F.max("mes").alias("_m")).select(
        "series_id", F.explode(F.sequence(F.add_months("_m", 1), F.add_months("_m", horizon), F.expr("interval 1 month"))).alias("mes"))
    rows = series.select("series_id", "mes", "y", F.lit("ajuste").alias("tipo")).unionByName(
        ahead.select("series_id", "mes", F.lit(None).cast("double").alias("y"), F.lit("previsao").alias("tipo")))
    return predict(fit(series), rows)
