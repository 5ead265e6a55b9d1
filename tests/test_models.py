"""Robust STL, augmented Dickey-Fuller, change-point forecast and movable feasts
against independent NumPy versions on many series at once."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderscope.operators import adf, changepoints, forecast, stl, tsa
from tenderscope.operators.calendar import easter, feast_days


def frame(spark, series):
    rows = [(sid, dt.date(2000 + i // 12, i % 12 + 1, 1), float(y)) for sid, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "series_id string, mes date, y double")


def many(n_series=50, seed=5):
    rng = np.random.default_rng(seed)
    out = {}
    for k in range(n_series):
        n = int(rng.integers(36, 90))
        t = np.arange(n)
        y = 1e6 * (50 + rng.normal(0, 0.6) * t + rng.uniform(1, 15) * np.sin(2 * np.pi * t / 12 + k) + rng.normal(0, 4, n))
        if k % 2:
            y = y + 1e6 * np.cumsum(rng.normal(0, 5, n))
        if k % 3 == 0:
            y[int(rng.integers(n))] *= 3
        out[f"s{k}"] = y
    return out


# -- STL ------------------------------------------------------------------------------

def local_line(y, w, q, x, lo, hi):
    """Weighted line over places lo..hi (from 1) read at x; None if no weight is left."""
    n = len(y)
    h = max(x - lo, hi - x) + ((q - n) // 2 if q > n else 0)
    j = np.arange(lo, hi + 1)
    r = np.abs(j - x)
    k = np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, (1 - (r / h) ** 3) ** 3, 0.0)) * w[lo - 1:hi]
    if k.sum() <= 0:
        return None
    k = k / k.sum()
    mean = (k * j).sum()
    spread = (k * (j - mean) ** 2).sum()
    if math.sqrt(spread) > 0.001 * (n - 1):
        k = k * ((x - mean) / spread * (j - mean) + 1)
    return float((k * y[lo - 1:hi]).sum())


def smooth(y, w, q):
    n, out = len(y), np.empty(len(y))
    for i in range(1, n + 1):
        lo, hi = (1, n) if q >= n else (min(max(1, i - (q + 1) // 2 + 1), n - q + 1), None)
        hi = hi or lo + q - 1
        v = local_line(y, w, q, i, lo, hi)
        out[i - 1] = y[i - 1] if v is None else v
    return out


def moving(x, k):
    return np.convolve(x, np.ones(k) / k, mode="valid")


def numpy_stl(y, outer):
    n, p = len(y), 12
    trend, seasonal, rw = np.zeros(n), np.zeros(n), np.ones(n)
    for _ in range(outer + 1):
        for _ in range(2):
            detrended, curve = y - trend, np.empty(n + 2 * p)
            for ph in range(p):
                u, uw = detrended[ph::p], rw[ph::p]
                s, k = smooth(u, uw, 7), len(u)
                a = local_line(u, uw, 7, 0, 1, min(7, k))
                z = local_line(u, uw, 7, k + 1, max(1, k - 6), k)
                whole = np.concatenate([[s[0] if a is None else a], s, [s[-1] if z is None else z]])
                curve[ph::p] = whole[:len(curve[ph::p])]
            low = smooth(moving(moving(moving(curve, p), p), 3), np.ones(n), 13)
            seasonal = curve[p:p + n] - low
            trend = smooth(y - seasonal, rw, 23)
        r = np.abs(y - trend - seasonal)
        s = np.sort(r)
        width = 3 * (s[n // 2] + s[n - n // 2 - 1])
        rw = np.where(r <= 0.001 * width, 1.0, np.where(r <= 0.999 * width, (1 - (r / width) ** 2) ** 2, 0.0)) if width > 0 else np.ones(n)
    return trend, seasonal


@pytest.mark.parametrize("robust", [True, False])
def test_stl_matches_numpy(spark, robust):
    series = many(12)
    got = {}
    for r in stl.stl(frame(spark, series), robust=robust).collect():
        got.setdefault(r.series_id, {})[r.rn] = (r.trend, r.seasonal)
    for sid, y in series.items():
        trend, seasonal = numpy_stl(y, 15 if robust else 0)
        mine = np.array([got[sid][i] for i in range(len(y))])
        assert np.abs(mine[:, 0] - trend).max() < 1e-6 * np.abs(y).max()
        assert np.abs(mine[:, 1] - seasonal).max() < 1e-6 * np.abs(y).max()


def test_stl_strength_resists_an_outlier(spark):
    t = np.arange(72)
    y = 100 + 0.5 * t + 10 * np.sin(2 * np.pi * t / 12) + np.random.default_rng(1).normal(0, 1, 72)
    y[30] += 400
    df = frame(spark, {"x": y})
    robust = tsa.strength(stl.stl(df)).first()
    classical = tsa.strength(tsa.decompose_additive(df)).first()
    trend, seasonal = numpy_stl(y, 15)
    resid = y - trend - seasonal
    fs, ft = (max(0, 1 - resid.var() / (c + resid).var()) for c in (seasonal, trend))
    assert robust.fs == pytest.approx(fs, abs=1e-6) and robust.ft == pytest.approx(ft, abs=1e-6)
    assert abs(robust.fs - classical.fs) > 0.05


def test_stl_short_and_constant_series(spark):
    df = frame(spark, {"short": np.arange(23.0), "flat": np.full(24, 7.0)})
    rows = stl.stl(df).collect()
    assert {r.series_id for r in rows} == {"flat"} and all(abs(r.trend - 7) < 1e-9 and abs(r.seasonal) < 1e-9 for r in rows)


# -- augmented Dickey-Fuller ------------------------------------------------------------

def fit_ols(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    return beta, float(((y - x @ beta) ** 2).sum())


def numpy_adf(y):
    n, dy = len(y), np.diff(y)
    limit = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    scale = np.abs(y).max()

    def design(lag, rows_from):
        rows = np.arange(rows_from, len(dy))
        return np.column_stack([np.ones(len(rows)), y[rows] / scale, *[dy[rows - k] / scale for k in range(1, lag + 1)]]), dy[rows] / scale

    best = []
    for lag in range(limit + 1):
        x, z = design(lag, limit)
        _, ssr = fit_ols(x, z)
        best.append((len(z) * math.log(ssr / len(z)) + 2 * x.shape[1], lag))
    lag = min(best)[1]
    x, z = design(lag, lag)
    beta, ssr = fit_ols(x, z)
    cov = ssr / (len(z) - x.shape[1]) * np.linalg.inv(x.T @ x)
    stat = beta[1] / math.sqrt(cov[1, 1])
    poly = (2.1659, 1.4412, 0.038269) if stat <= -1.61 else (1.7339, 0.93202, -0.12745, -0.010368)
    z0 = sum(c * stat ** k for k, c in enumerate(poly))
    p = 1.0 if stat > 2.74 else 0.0 if stat < -18.83 else 0.5 * math.erfc(-z0 / math.sqrt(2))
    return stat, lag, len(z), p


def test_adf_matches_numpy(spark):
    series = many(50)
    got = {r.series_id: r for r in adf.augmented_dickey_fuller(frame(spark, series)).collect()}
    orders = set()
    for sid, y in series.items():
        stat, lag, nobs, p = numpy_adf(y)
        r = got[sid]
        assert (r.adf_lags, r.adf_nobs) == (lag, nobs)
        assert r.adf_stat == pytest.approx(stat, abs=2e-6) and r.adf_pvalue == pytest.approx(p, abs=2e-6)
        assert r.d == (0 if p < 0.05 else 1)
        stat1, _, _, p1 = numpy_adf(np.diff(y))
        assert r.adf_stat_d1 == pytest.approx(stat1, abs=2e-5) and r.adf_pvalue_d1 == pytest.approx(p1, abs=2e-6)
        orders.add(r.d)
    assert orders == {0, 1} and len({r.adf_lags for r in got.values()}) > 3


def test_adf_short_and_constant_series(spark):
    rows = {r.series_id: r for r in adf.augmented_dickey_fuller(frame(spark, {"a": [1, 2, 3], "b": [5] * 30, "c": [1, 4, 2, 5]})).collect()}
    assert "a" not in rows and rows["b"].adf_stat is None and rows["b"].d == 1 and rows["c"].adf_lags == 0


# -- change points and feasts -------------------------------------------------------------

EASTER = {1961: (4, 2), 1999: (4, 4), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2019: (4, 21), 2020: (4, 12), 2021: (4, 4), 2022: (4, 17),
          2023: (4, 9), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25), 2049: (4, 18), 2076: (4, 19)}


def easter_by_tables(year):
    """Epact form of the calendar reform's rule, independent of the operator's."""
    century = year // 100 + 1
    skipped = 3 * century // 4 - 12
    correction = (8 * century + 5) // 25 - 5
    sunday = 5 * year // 4 - skipped - 10
    golden = year % 19 + 1
    epact = (11 * golden + 20 + correction - skipped) % 30
    if (epact == 25 and golden > 11) or epact == 24:
        epact += 1
    moon = 44 - epact
    if moon < 21:
        moon += 30
    moon += 7 - (sunday + moon) % 7
    return dt.date(year, 4, moon - 31) if moon > 31 else dt.date(year, 3, moon)


def test_movable_feasts(spark):
    years = spark.range(1960, 2100).select(F.col("id").cast("int").alias("y"))
    got = {r.y: r.e for r in years.select("y", F.expr(easter("y")).alias("e")).collect()}
    assert got == {y: easter_by_tables(y) for y in range(1960, 2100)}
    assert all(got[y] == dt.date(y, *md) for y, md in EASTER.items())
    months = years.select("y", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    rows = months.select("y", "m", *[F.expr(x).alias(c) for c, x in feast_days("m", "y").items()]).collect()
    for name, days in {"carnaval": (-48, -47), "sexta_feira_santa": (-2,), "corpus_christi": (60,)}.items():
        want = {}
        for y in range(1960, 2100):
            for d in days:
                at = easter_by_tables(y) + dt.timedelta(d)
                want[y, at.month] = want.get((y, at.month), 0) + 1
        assert {(r.y, r.m): r[name] for r in rows if r[name]} == want


def numpy_changepoints(y, horizon):
    n = len(y)
    top, t = np.abs(y).max(), np.arange(n + horizon) / (n - 1)
    slope, icpt = np.polyfit(t[:n], y / top, 1)
    last = int(n * 0.8) - 1
    count = min(25, last)
    bends = t[np.round(np.arange(1, count + 1) * last / count).astype(int)]
    moy, year = np.arange(n + horizon) % 12, 2000 + np.arange(n + horizon) // 12
    a = 2 * np.pi * moy / 12
    season = [f(k * a) for k in range(1, 6) for f in (np.sin, np.cos)] + [np.cos(6 * a)]
    for days in ((-48, -47), (-2,), (60,)):
        season.append(np.array([sum((easter_by_tables(int(yy)) + dt.timedelta(d)).month == m + 1 for d in days) for yy, m in zip(year, moy)], float))
    line = icpt + slope * t
    x = np.column_stack([np.ones_like(t), t, *[np.maximum(t - c, 0) for c in bends], *[line * s for s in season]])
    penalty = np.diag([0.0, 0.0] + [0.3] * count + [0.001] * len(season))
    w = np.linalg.solve(x[:n].T @ x[:n] + penalty, x[:n].T @ (y / top))
    fit = x @ w
    lo, hi = np.quantile(y / top - fit[:n], [0.05, 0.95])
    return fit * top, (fit + lo) * top, (fit + hi) * top


def test_changepoint_forecast_matches_numpy(spark):
    series = {k: np.abs(v) for k, v in many(10).items()}
    got = {}
    for r in changepoints.future(frame(spark, series)).collect():
        got.setdefault(r.series_id, {})[r.mes] = (r.yhat, r.yhat_lower, r.yhat_upper, r.tipo)
    for sid, y in series.items():
        want = np.column_stack(numpy_changepoints(y, 12))
        rows = [got[sid][k] for k in sorted(got[sid])]
        assert [r[3] for r in rows] == ["ajuste"] * len(y) + ["previsao"] * 12
        assert np.abs(np.array([r[:3] for r in rows], float) - want).max() < 1e-6 * np.abs(y).max()


def test_changepoint_forecast_beats_the_straight_line_on_a_break(spark):
    t = np.arange(84)
    rng = np.random.default_rng(2)
    y = np.where(t < 40, 100 + 2.0 * t, 180 - 1.5 * (t - 40)) * (1 + 0.1 * np.sin(2 * np.pi * t / 12)) + rng.normal(0, 1, 84)
    split = forecast.train_test(frame(spark, {"x": y}))
    bent = forecast.metrics(changepoints.validation(split)).first()
    straight = forecast.metrics(forecast.seasonal_validation(split)).first()
    assert bent.mape < 0.5 * straight.mape


def test_changepoint_forecast_short_and_zero_series(spark):
    rows = changepoints.future(frame(spark, {"short": [1, 2, 3], "zero": [0] * 30, "ok": list(range(1, 20))})).collect()
    assert {r.series_id for r in rows} == {"ok"} and all(math.isfinite(r.yhat) for r in rows)


def test_stl_of_many_series_together(spark):
    """Series of one length are fitted together, and each comes out as if alone; 600 of them in seconds."""
    import time
    rng = np.random.default_rng(3)
    series = {f"s{i:03d}": 50 + rng.normal(0, 5, 24 + i % 3 * 13) + 10 * np.sin(np.arange(24 + i % 3 * 13) * np.pi / 6) for i in range(600)}
    df = frame(spark, series)
    start = time.time()
    got = {(r.series_id, r.rn): (r.trend, r.seasonal) for r in stl.stl(df).collect()}
    assert time.time() - start < 60 and len(got) == sum(map(len, series.values()))
    alone = stl.stl(df.where("series_id in ('s001', 's002')")).collect()
    assert len(alone) == len(series["s001"]) + len(series["s002"])
    assert all(got[r.series_id, r.rn] == (r.trend, r.seasonal) for r in alone)
