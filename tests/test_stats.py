"""Series statistics against brute-force NumPy on small series (the
operators without an oracle SQL text are checked here)."""

import datetime as dt
import math

import numpy as np

from tenderscope.operators import tsa


def _series(spark, ys, sid="s"):
    rows = [(sid, dt.date(2000 + i // 12, i % 12 + 1, 1), float(y)) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "series_id string, mes date, y double")


def _ys(n=60, seed=3):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 100 + 0.8 * t + 10 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 3, n)


def _acf(x, nlags):
    c = x - x.mean()
    g0 = (c * c).sum()
    return np.array([(c[: len(c) - k] * c[k:]).sum() / g0 for k in range(nlags + 1)])


def test_acf_matches_numpy(spark):
    ys = _ys()
    got = {r.lag: r.acf for r in tsa.acf(_series(spark, ys)).collect()}
    want = _acf(ys, min(36, len(ys) // 2 - 1))
    assert len(got) == len(want)
    for k, v in enumerate(want):
        assert abs(got[k] - round(v, 6)) < 2e-6


def test_pacf_matches_durbin_levinson(spark):
    ys = _ys()
    L = len(ys) // 2 - 1
    r = _acf(ys, L)
    phi, pac = np.zeros(0), []
    for m in range(1, L + 1):
        k = (r[m] - (phi * r[m - 1:0:-1]).sum()) / (1 - (phi * r[1:m]).sum())
        phi = np.append(phi - k * phi[::-1], k)
        pac.append(k)
    got = {row.lag: row.pacf for row in tsa.pacf(_series(spark, ys)).collect()}
    for m, v in enumerate(pac, start=1):
        assert abs(got[m] - v) < 2e-6


def test_ljung_box_matches_closed_form(spark):
    ys = _ys(50)
    n = len(ys)
    r = _acf(ys, 24)
    got = {row.lag: (row.lb_stat, row.lb_pvalue) for row in tsa.ljung_box(_series(spark, ys)).collect()}
    for h in (12, 24):
        q = n * (n + 2) * sum(r[k] ** 2 / (n - k) for k in range(1, h + 1))
        p = math.exp(-q / 2) * sum((q / 2) ** j / math.factorial(j) for j in range(h // 2))
        assert abs(got[h][0] - q) < 1e-3 and abs(got[h][1] - p) < 1e-5


def test_kpss_matches_reference_algorithm(spark):
    ys = _ys(72)
    n = len(ys)
    t = np.arange(1, n + 1)
    b, a = np.polyfit(t, ys, 1)
    e = ys - (a + b * t)
    covlags = int(n ** (2 / 9))
    s0, s1 = (e ** 2).sum() / n, 0.0
    for i in range(1, covlags + 1):
        p = np.dot(e[i:], e[: n - i]) / (n / 2)
        s0 += p
        s1 += i * p
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    s2 = (e ** 2).sum() + 2 * sum(np.dot(e[i:], e[: n - i]) * (1 - i / (lags + 1)) for i in range(1, lags + 1))
    stat = (np.cumsum(e) ** 2).sum() / n ** 2 / (s2 / n)
    pval = float(np.interp(stat, [0.119, 0.146, 0.176, 0.216], [0.10, 0.05, 0.025, 0.01]))
    r = tsa.kpss_trend(_series(spark, ys)).collect()[0]
    assert r.kpss_lags == lags
    assert abs(r.kpss_stat - stat) < 2e-6 and abs(r.kpss_pvalue - pval) < 2e-6


def test_dickey_fuller_t_matches_least_squares(spark):
    ys = _ys(60)
    y1, dy = ys[:-1], np.diff(ys)
    X = np.column_stack([np.ones_like(y1), y1])
    beta, res, *_ = np.linalg.lstsq(X, dy, rcond=None)
    resid = dy - X @ beta
    s2 = (resid ** 2).sum() / (len(dy) - 2)
    se = math.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1])
    r = tsa.dickey_fuller(_series(spark, ys)).collect()[0]
    assert abs(r.df_stat - beta[1] / se) < 1e-5


def test_stationary_form_differences_a_random_walk_only(spark):
    rng = np.random.default_rng(5)
    noise = rng.normal(size=80)
    walk = np.cumsum(rng.normal(size=80)) + np.arange(80) * 3.0
    for ys, want in ((noise, noise), (walk, np.diff(walk))):
        got = tsa.stationary_form(_series(spark, ys)).where("y is not null").orderBy("mseq").collect()
        assert np.allclose([r.y for r in got], want)
