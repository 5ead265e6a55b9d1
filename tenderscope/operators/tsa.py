"""Decomposition, dependence and stationarity, grouped by series.

Everything is a native expression.  Operators that need the whole ordered
series (autocorrelations, Durbin–Levinson, KPSS) gather one series into an
array first: a monthly series has at most #calendar-months values (bounded
by the calendar, not by the data volume), and the arrays of different series
are spread over all tasks.  The math then runs in higher-order functions
(``transform`` / ``aggregate``); no pair of rows is ever materialised."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from .util import rnd

from .util import month_seq


def _ordered(series: DataFrame, col: str = "y") -> DataFrame:
    s = series.where(F.col(col).isNotNull())
    if "mseq" not in s.columns:
        s = s.withColumn("mseq", month_seq("mes"))
    return s


def decompose_additive(series: DataFrame, period: int = 12, col: str = "y") -> DataFrame:
    """Classical additive decomposition by row position.  Trend: centred
    2×12 moving average (null for the first and last 6 rows); seasonal: mean
    detrended value per phase, shifted to zero mean; resid = y − trend −
    seasonal.  Series shorter than two periods give no rows."""
    s = _ordered(series, col)
    w = Window.partitionBy("series_id").orderBy("mseq")
    half = period // 2
    s = s.select("series_id", "mes", "mseq", F.col(col).alias("y"),
                 (F.row_number().over(w) - 1).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("series_id")).alias("n"))
    s = s.where(F.col("n") >= 2 * period)
    outer = F.sum("y").over(w.rowsBetween(-half, half))
    inner = F.sum("y").over(w.rowsBetween(-(half - 1), half - 1))
    trend = F.when((F.col("rn") >= half) & (F.col("rn") < F.col("n") - half), (outer + inner) / (2 * period))
    s = s.select("*", trend.alias("trend"), (F.col("rn") % period).alias("fase"))
    ph = s.groupBy("series_id", "fase").agg(F.avg(F.col("y") - F.col("trend")).alias("_m"))
    ph = ph.select("series_id", "fase", (F.col("_m") - F.avg("_m").over(Window.partitionBy("series_id"))).alias("seasonal"))
    j = s.join(ph, on=["series_id", "fase"])
    return j.select("series_id", "mes", "mseq", "rn", "y", "trend", "seasonal",
                    (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


def strength(decomposed: DataFrame) -> DataFrame:
    """Fs = max(0, 1 − var(R)/var(S+R)), Ft = max(0, 1 − var(R)/var(T+R))
    (population variances over the rows with a residual)."""
    d = decomposed.where(F.col("resid").isNotNull())
    a = d.groupBy("series_id").agg(
        F.var_pop("resid").alias("_vr"), F.var_pop(F.col("seasonal") + F.col("resid")).alias("_vsr"),
        F.var_pop(F.col("trend") + F.col("resid")).alias("_vtr"))
    fs = F.greatest(F.lit(0.0), F.lit(1.0) - F.try_divide("_vr", "_vsr"))
    ft = F.greatest(F.lit(0.0), F.lit(1.0) - F.try_divide("_vr", "_vtr"))
    return a.select("series_id", fs.alias("fs"), ft.alias("ft"))


# Fixed values (must equal the study's labels and cut-offs): strength above
# 0.64 is strong, above 0.4 moderate, else weak; the STL line only says strong
# or weak; a seasonal strength above 0.4 advises the seasonal model family.
STRONG, MODERATE = 0.64, 0.4
LABEL_STRONG, LABEL_MODERATE, LABEL_WEAK, LABEL_WEAK_STL = "FORTE", "MODERADA", "FRACA", "fraca"
MODEL_SEASONAL, MODEL_PLAIN = "SARIMA", "ARIMA"


def _level(x):
    return F.when(x > STRONG, F.lit(LABEL_STRONG)).when(x > MODERATE, F.lit(LABEL_MODERATE)).otherwise(F.lit(LABEL_WEAK))


def diagnosis(strengths: DataFrame) -> DataFrame:
    """Labels (STL line: strong above 0.64 else weak; diagnosis:
    strong > 0.64, moderate > 0.4, else weak) and the model family advice."""
    fs, ft = F.col("fs"), F.col("ft")
    return strengths.select(
        "series_id", rnd(fs, 6).alias("fs"), rnd(ft, 6).alias("ft"),
        F.when(fs > STRONG, F.lit(LABEL_STRONG)).otherwise(F.lit(LABEL_WEAK_STL)).alias("stl_fs"),
        F.when(ft > STRONG, F.lit(LABEL_STRONG)).otherwise(F.lit(LABEL_WEAK_STL)).alias("stl_ft"),
        _level(fs).alias("diagnostico_fs"), _level(ft).alias("diagnostico_ft"),
        F.when(fs > MODERATE, F.lit(MODEL_SEASONAL)).otherwise(F.lit(MODEL_PLAIN)).alias("modelo"))


def series_arrays(series: DataFrame, col: str = "y") -> DataFrame:
    """One row per series: its values in month order (``ys``) and ``n``."""
    s = _ordered(series, col)
    a = s.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("mseq", F.col(col).alias("v")))).alias("_p"))
    return a.select("series_id", F.transform("_p", lambda p: p["v"]).alias("ys")).withColumn("n", F.size("ys"))


def rng(a: str, b: str) -> str:
    """``sequence(a, b)`` that is empty when b < a (Spark's counts down)."""
    return f"if(({b}) >= ({a}), sequence({a}, {b}), cast(array() as array<int>))"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value`` evaluated once per row.

    Catalyst inlines a projected column into every place it is used; inside a
    lambda that means once per element.  Wrapping the value in a one-element
    array and transforming it evaluates it once and gives the lambda a name."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _g(c: str, k: str) -> str:
    """Σ_{t<n-k} c[t]·c[t+k] over a centred array (0-based subscripts)."""
    return f"aggregate(sequence(0, size({c}) - 1 - {k}), 0D, (acc, t) -> acc + {c}[t] * {c}[t + {k}])"


def _centred(ys: str) -> str:
    return let(f"aggregate({ys}, 0D, (s, x) -> s + x) / size({ys})", "mu", f"transform({ys}, v -> v - mu)")


def acf_arrays(arrs: DataFrame, max_lag_expr: str = "least(36, n div 2 - 1)") -> DataFrame:
    """X5 on arrays: biased autocorrelations r(0..L) (÷ g(0)) per series.
    Every derived array is referenced once by the next step (see ``let``)."""
    a = arrs.withColumn("L", F.expr(f"cast({max_lag_expr} as int)")).where("L >= 0")
    g = let(_centred("ys"), "c", f"transform(sequence(0, L), k -> {_g('c', 'k')})")
    return a.withColumn("r", F.expr(let(g, "g", "transform(g, x -> x / g[0])")))


def acf(series: DataFrame, col: str = "y") -> DataFrame:
    """Autocorrelation to lag min(36, n/2−1), with the ±1.96/√n band and the
    band that widens with the squared autocorrelations before the lag."""
    a = acf_arrays(series_arrays(series, col))
    earlier = f"aggregate({rng('1', 'k - 1')}, 0D, (s, j) -> s + r[j] * r[j])"
    wide = F.expr(let("r", "r", f"transform(r, (x, k) -> named_struct('acf', x, 'wide', if(k = 0, 0D, 1.96D * sqrt((1 + 2 * {earlier}) / n))))"))
    e = a.select("series_id", "n", F.posexplode(wide).alias("lag", "p"))
    return e.select("series_id", F.col("lag").cast("bigint").alias("lag"), rnd(F.col("p.acf"), 6).alias("acf"),
                    rnd(F.lit(1.96) / F.sqrt("n"), 6).alias("banda"), rnd(F.col("p.wide"), 6).alias("banda_bartlett"))


def pacf(series: DataFrame, col: str = "y") -> DataFrame:
    """Partial autocorrelation to lag n/2−1 by Yule–Walker (biased acf),
    Durbin–Levinson recursion as one ``aggregate`` over the lags."""
    a = acf_arrays(series_arrays(series, col), "n div 2 - 1").where("L >= 1")
    r1 = rng("1", "m - 1")
    kappa = (f"(r[m] - aggregate({r1}, 0D, (s, i) -> s + st.phi[i - 1] * r[m - i]))"
             f" / (1 - aggregate({r1}, 0D, (s, i) -> s + st.phi[i - 1] * r[i]))")
    nxt = ("named_struct('phi', concat(transform(" + r1 + ", i -> st.phi[i - 1] - kappa * st.phi[m - i - 1]), array(kappa)),"
           " 'pac', concat(st.pac, array(kappa)))")
    dl = (f"aggregate(sequence(1, L), named_struct('phi', cast(array() as array<double>), 'pac', cast(array() as array<double>)),"
          f" (st, m) -> {let(kappa, 'kappa', nxt)}).pac")
    a = a.withColumn("pac", F.expr(let("r", "r", dl)))
    e = a.select("series_id", "n", F.posexplode("pac").alias("_i", "pacf"))
    return e.select("series_id", (F.col("_i") + 1).cast("bigint").alias("lag"), rnd("pacf", 6).alias("pacf"),
                    rnd(F.lit(1.96) / F.sqrt("n"), 6).alias("banda"))


def stationary_form(series: DataFrame, col: str = "y") -> DataFrame:
    """The series the correlograms are drawn from: as it is where the
    stationarity test gives d = 0, its first difference where d = 1.  Series too
    short for the test stay as they are."""
    s = _ordered(series, col)
    order = dickey_fuller(s, col).select("series_id", "d")
    w = Window.partitionBy("series_id").orderBy("mseq")
    both = s.select("series_id", "mes", "mseq", F.col(col).alias("y"), (F.col(col) - F.lag(col).over(w)).alias("dy"))
    j = both.join(order, on="series_id", how="left")
    return j.select("series_id", "mes", "mseq", F.when(F.col("d") == 1, F.col("dy")).otherwise(F.col("y")).alias("y"))


def ljung_box(series: DataFrame, lags=(12, 24), col: str = "y") -> DataFrame:
    """Q = n(n+2) Σ_{k≤h} r_k²/(n−k); even h → chi-square survival in
    closed form p = e^(−Q/2) Σ_{j<h/2} (Q/2)^j / j!."""
    hmax = max(lags)
    a = acf_arrays(series_arrays(series, col), f"least({hmax}, n - 1)")
    for h in lags:
        if h % 2:
            raise ValueError("closed-form p-value needs an even lag")
    hs = F.array(*[F.lit(h) for h in lags])
    q_of = ("transform(hs, h -> named_struct('h', h, 'q', n * (n + 2D) * aggregate(" + rng("1", "least(h, L)") +
            ", 0D, (s, k) -> s + r[k] * r[k] / (n - k))))")
    a = a.withColumn("hs", hs).withColumn("qs", F.expr(let("r", "r", q_of)))
    e = a.select("series_id", F.explode("qs").alias("x")).select("series_id", F.col("x.h").cast("bigint").alias("lag"), F.col("x.q").alias("q"))
    p = F.expr("exp(-q / 2) * aggregate(sequence(0, cast(lag div 2 - 1 as int)), named_struct('s', 0D, 't', 1D),"
               " (acc, j) -> named_struct('s', acc.s + acc.t, 't', acc.t * (q / 2) / (j + 1))).s")
    return e.select("series_id", "lag", rnd("q", 4).alias("lb_stat"), rnd(p, 6).alias("lb_pvalue"))


def kpss_trend(series: DataFrame, col: str = "y") -> DataFrame:
    """KPSS with constant and trend, automatic lag (Hobijn et al. 1998);
    p by linear interpolation in the 4-point table, clipped.  Stationary
    when p ≥ 0.05."""
    a = series_arrays(series, col).where("n >= 3")
    # OLS residuals of y on t = 1..n (slope from centred sums)
    resid = let(
        "named_struct('mt', (n + 1) / 2D, 'my', aggregate(ys, 0D, (s, x) -> s + x) / n)", "m",
        let("aggregate(sequence(1, n), 0D, (s, i) -> s + (i - m.mt) * (ys[i - 1] - m.my))"
            " / aggregate(sequence(1, n), 0D, (s, i) -> s + (i - m.mt) * (i - m.mt))", "b",
            "transform(ys, (v, i) -> v - (m.my + b * (i + 1 - m.mt)))"))
    a = a.withColumn("c", F.expr(resid))
    stats = let("cast(floor(pow(n, 2D / 9D)) as int)", "covl", let(
        f"transform({rng('1', 'covl')}, k -> {_g('c', 'k')} / (n / 2D))", "pk", let(
            "named_struct('s0', aggregate(c, 0D, (s, x) -> s + x * x) / n + aggregate(pk, 0D, (s, x) -> s + x),"
            f" 's1', aggregate({rng('1', 'covl')}, 0D, (s, i) -> s + i * pk[i - 1]))", "ss", let(
                "least(cast(floor(1.1447 * pow(pow(ss.s1 / ss.s0, 2), 1D / 3D) * pow(n, 1D / 3D)) as int), n - 1)", "lags",
                f"named_struct('lags', lags, 's2', (aggregate(c, 0D, (s, x) -> s + x * x) + 2 * aggregate({rng('1', 'lags')}, 0D,"
                f" (s, k) -> s + {_g('c', 'k')} * (1 - k / (lags + 1D)))) / n,"
                " 'eta', aggregate(c, named_struct('cs', 0D, 'ss', 0D),"
                " (st, x) -> named_struct('cs', st.cs + x, 'ss', st.ss + (st.cs + x) * (st.cs + x))).ss / (n * n))"))))
    a = a.withColumn("k", F.expr(let("c", "c", stats)))
    a = a.select("series_id", F.col("k.lags").alias("lags"), (F.col("k.eta") / F.col("k.s2")).alias("stat"))
    p = (F.when(F.col("stat") <= 0.119, 0.10)
         .when(F.col("stat") <= 0.146, 0.10 + (F.col("stat") - 0.119) * (0.05 - 0.10) / (0.146 - 0.119))
         .when(F.col("stat") <= 0.176, 0.05 + (F.col("stat") - 0.146) * (0.025 - 0.05) / (0.176 - 0.146))
         .when(F.col("stat") <= 0.216, 0.025 + (F.col("stat") - 0.176) * (0.01 - 0.025) / (0.216 - 0.176))
         .otherwise(0.01))
    return a.select("series_id", rnd("stat", 6).alias("kpss_stat"), rnd(p, 6).alias("kpss_pvalue"),
                    F.col("lags").cast("bigint").alias("kpss_lags"), (p >= 0.05).alias("estacionaria"))


def _df_stats(s: DataFrame, ycol: str) -> DataFrame:
    w = Window.partitionBy("series_id").orderBy("mseq")
    d = s.select("series_id", F.col(ycol).alias("yl"), (F.lead(ycol).over(w) - F.col(ycol)).alias("dy")).where(F.col("dy").isNotNull())
    a = d.groupBy("series_id").agg(
        F.regr_slope("dy", "yl").alias("b"), F.regr_sxx("dy", "yl").alias("sxx"), F.regr_syy("dy", "yl").alias("syy"),
        F.regr_sxy("dy", "yl").alias("sxy"), F.regr_count("dy", "yl").alias("m"))
    left = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    se = F.sqrt(F.try_divide(left, (F.col("m") - 2) * F.col("sxx")))
    crit = F.lit(-2.8621) - F.lit(2.738) / F.col("m") - F.lit(8.36) / (F.col("m") * F.col("m"))
    return a.where("m > 2").select("series_id", F.try_divide(F.col("b"), se).alias("t"), crit.alias("crit"))


def dickey_fuller(series: DataFrame, col: str = "y") -> DataFrame:
    """X9 (re-aimed, lag 0): t of the slope of Δy on y₋₁ with constant against
    the finite-sample 5 % critical value; not stationary → difference once
    and test again; order d (the study stops at d = 1)."""
    s = _ordered(series, col)
    t0 = _df_stats(s, col)
    w = Window.partitionBy("series_id").orderBy("mseq")
    ds = s.select("series_id", "mseq", (F.col(col) - F.lag(col).over(w)).alias("dy1")).where(F.col("dy1").isNotNull())
    t1 = _df_stats(ds, "dy1").withColumnsRenamed({"t": "t1", "crit": "crit1"})
    j = t0.join(t1, on="series_id", how="left")
    st0 = F.col("t") < F.col("crit")
    st1 = F.col("t1") < F.col("crit1")
    return j.select("series_id", rnd("t", 6).alias("df_stat"), rnd("crit", 6).alias("df_crit5"), st0.alias("estacionaria"),
                    rnd("t1", 6).alias("df_stat_d1"), st1.alias("estacionaria_d1"),
                    F.when(st0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("d"))
