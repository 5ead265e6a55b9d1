"""Seasonal-trend decomposition by local regression (STL), robust form.

The published procedure (Cleveland, Cleveland, McRae and Terpenning, 1990) for a
period of 12: in every inner step the detrended values of each calendar month
are smoothed along the years, the level of that seasonal curve is taken out by
moving averages and a smoother, and the trend is smoothed from what is left;
every outer step gives months with large remainders less weight.  Windows are
those of the study's call (seasonal 7, trend 23, low-pass 13, all linear; two
inner and, robust, fifteen outer steps).

One series is one row: its months (bounded by the calendar) in an array.  The
series are dealt over all tasks, and a task fits the series of one length
together: each step is a few array operations over all of them, added up in the
order of the places, so a series' result does not depend on its neighbours."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .tsa import series_arrays

PERIOD, SEASONAL, TREND, LOW_PASS, INNER, OUTER = 12, 7, 23, 13, 2, 15


#: series of one length fitted together
TOGETHER = 256


@functools.lru_cache(maxsize=4096)
def _window(n: int, q: int, x: int, lo: int, hi: int):
    """Places (from 0), distances and tricube weights of lo..hi seen from place x (from 1)."""
    j = np.arange(lo, hi + 1)
    h = max(x - lo, hi - x) + ((q - n) // 2 if q > n else 0)
    dist = np.abs(j - x)
    with np.errstate(all="ignore"):
        weight = np.where(dist <= 0.001 * h, 1.0, np.where(dist <= 0.999 * h, (1.0 - (dist / h) ** 3.0) ** 3.0, 0.0))
    return j - 1, (j - x).astype(float), weight


def _fit(y, w, n: int, windows):
    """Weighted linear fits of the rows of ``y``, one per window of equal length, read
    at the windows' own places; NaN where all weights vanish."""
    place, away, tricube = (np.stack(a) for a in zip(*windows))
    s0, s1, s2, t0, t1 = (np.zeros((len(y), len(windows))) for _ in range(5))
    for k in range(place.shape[1]):
        at, d = place[:, k], away[:, k]
        v = w[:, at] * tricube[:, k]
        vy = v * y[:, at]
        s0, s1, s2, t0, t1 = s0 + v, s1 + v * d, s2 + v * d * d, t0 + vy, t1 + vy * d
    with np.errstate(all="ignore"):
        c = s1 / s0
        d = s2 / s0 - c * c
        level = t0 / s0
        tilted = np.where(np.sqrt(np.maximum(d, 0.0)) > 0.001 * (n - 1), level - c / d * (t1 / s0 - c * t0 / s0), level)
    return tilted, s0 > 0


def _smooth(y, w, q: int):
    """The smoother at every place of the rows of ``y``."""
    n = y.shape[1]
    first = lambda i: 1 if q >= n else max(1, min(i - ((q + 1) // 2 - 1), n - (q - 1)))
    fit, some = _fit(y, w, n, [_window(n, q, i, first(i), min(n, first(i) + q - 1)) for i in range(1, n + 1)])
    return np.where(some, fit, y)


def _moving(x, size: int):
    total = np.zeros((len(x), x.shape[1] - size + 1))
    for k in range(size):
        total = total + x[:, k:k + total.shape[1]]
    return total / size


def _month_curves(y, w):
    """Each calendar month's smoothed values, one place longer at both ends, back
    in time order (period places longer at both ends)."""
    out = np.empty((len(y), y.shape[1] + 2 * PERIOD))
    for ph in range(PERIOD):
        u, uw = y[:, ph::PERIOD], w[:, ph::PERIOD]
        k = u.shape[1]
        mid = _smooth(u, uw, SEASONAL)
        edge = lambda near, *at: np.where(*(lambda fit, some: (some, fit, near[:, None]))(*_fit(u, uw, k, [_window(k, SEASONAL, *at)])))
        out[:, ph::PERIOD] = np.hstack([edge(mid[:, 0], 0, 1, min(SEASONAL, k)), mid, edge(mid[:, -1], k + 1, max(1, k - SEASONAL + 1), k)])
    return out


def _weights(left):
    """Bisquare weights from the sizes of the remainders, six median deviations wide."""
    n = left.shape[1]
    ranked = np.sort(left, axis=1)
    wide = (3.0 * (ranked[:, n // 2] + ranked[:, n - n // 2 - 1]))[:, None]
    with np.errstate(all="ignore"):
        inside = np.where(left <= 0.999 * wide, (1.0 - (left / wide) ** 2.0) ** 2.0, 0.0)
    return np.where((wide <= 0) | (left <= 0.001 * wide), 1.0, inside)


def _decompose(ys, outer: int):
    """Trend and seasonal of the rows of ``ys``, all of one length."""
    n, one = ys.shape[1], np.ones_like(ys)
    trend, seasonal, rw = np.zeros_like(ys), np.zeros_like(ys), one
    for _ in range(outer + 1):
        for _ in range(INNER):
            curve = _month_curves(ys - trend, rw)
            low = _smooth(_moving(_moving(_moving(curve, PERIOD), PERIOD), 3), one, LOW_PASS)
            seasonal = curve[:, PERIOD:PERIOD + n] - low
            trend = _smooth(ys - seasonal, rw, TREND)
        rw = _weights(np.abs(ys - trend - seasonal))
    return trend, seasonal


def _fit_batches(batches: Iterator[pd.DataFrame], outer: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, same in batch.groupby(batch["ys"].map(len)):
            for i in range(0, len(same), TOGETHER):
                some = same.iloc[i:i + TOGETHER]
                trend, seasonal = _decompose(np.stack(some["ys"].to_numpy()), outer)
                yield some.assign(trend=list(trend), seasonal=list(seasonal))


def stl_arrays(series: DataFrame, col: str = "y", robust: bool = True) -> DataFrame:
    """Per series (at least two periods long): ``ys``, ``trend``, ``seasonal`` in month order."""
    a = series_arrays(series, col).where(f"n >= {2 * PERIOD}")
    # little data and much work: the series are dealt over all tasks, not merged into few
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = a.repartition(tasks, "series_id").select("series_id", F.col("ys").cast("array<double>"))
    out = StructType([*a.schema, *[StructField(c, ArrayType(DoubleType())) for c in ("trend", "seasonal")]])
    outer = OUTER if robust else 0
    return a.mapInPandas(lambda batches: _fit_batches(batches, outer), out)


def stl(series: DataFrame, col: str = "y", robust: bool = True) -> DataFrame:
    """(series_id, rn, y, trend, seasonal, resid), rn the place in the series from 0."""
    a = stl_arrays(series, col, robust)
    e = a.select("series_id", F.posexplode(F.arrays_zip("ys", "trend", "seasonal")).alias("rn", "v"))
    return e.select("series_id", "rn", F.col("v.ys").alias("y"), "v.trend", "v.seasonal",
                    (F.col("v.ys") - F.col("v.trend") - F.col("v.seasonal")).alias("resid"))
