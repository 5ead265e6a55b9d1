"""Augmented Dickey-Fuller test with the lag chosen by AIC.

Every lag count up to the usual limit is one least-squares fit with a constant,
the lagged level and that many lagged differences, all on the same rows.  The
fits are nested, so eliminating the columns of one cross-product matrix in turn
gives the residual sum of squares of each; the statistic then comes from a
second, smaller matrix on all the rows the chosen lag leaves.  A series is one
row with its months in an array; matrices have a few columns (bounded by the
lag limit) whatever the number of series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tsa import let, rng, series_arrays
from .util import rnd

# Fixed values (published response surfaces for a constant, one series): the
# p-value is the normal distribution function of a polynomial in the statistic,
# with one set of coefficients up to the turning point and one above; the
# critical values are polynomials in 1 / rows.
TURN, LEAST, MOST = -1.61, -18.83, 2.74
SMALL = (2.1659, 1.4412, 0.038269)
LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {"1": (-3.43035, -6.5393, -16.786, -79.433), "5": (-2.86154, -2.8903, -4.234, -40.04), "10": (-2.56677, -1.5384, -2.809, 0.0)}
LEVEL = 0.05


def polynomial(coefficients, x: str) -> str:
    return "(" + " + ".join(f"({c!r}D)" + f" * {x}" * k for k, c in enumerate(coefficients)) + ")"


def _standard(a: str) -> str:
    """Centred, and scaled to length one (a constant column stays zero)."""
    mean = f"aggregate({a}, 0D, (s, x) -> s + x) / size({a})"
    return let(mean, "mu", let(f"transform({a}, x -> x - mu)", "ce", let("sqrt(aggregate(ce, 0D, (s, x) -> s + x * x))", "le",
                                                                       "if(le > 0, transform(ce, x -> x / le), ce)")))


def _products(columns: str) -> str:
    dot = "aggregate(sequence(0, size(u) - 1), 0D, (s, t) -> s + u[t] * v[t])"
    return let(f"transform({columns}, c -> {_standard('c')})", "z", f"transform(z, u -> transform(z, v -> {dot}))")


def _eliminated(a: str, k: str) -> str:
    """The matrix once column k is eliminated from the rows below it (null where its pivot is zero)."""
    return f"transform({a}, (row, i) -> if(i <= {k}, row, transform(row, (v, j) -> v - row[{k}] * {a}[{k}][j] / nullif({a}[{k}][{k}], 0D))))"


def adf_struct(ys: str) -> str:
    """SQL expression: (stat, lags, nobs) of the array ``ys``; null for series too short."""
    limit = f"cast(least(ceil(12 * pow(size({ys}) / 100D, 0.25D)), size({ys}) div 2 - 2) as int)"
    lagged = lambda p: f"transform({rng('1', p)}, l -> slice(dx, {p} - l + 1, size(dx) - {p}))"
    level = lambda p: f"array(slice({ys}, {p} + 1, size(dx) - {p}))"
    now = lambda p: f"array(slice(dx, {p} + 1, size(dx) - {p}))"
    wide = f"concat({level('mx')}, {lagged('mx')}, {now('mx')})"
    sweep = ("aggregate(sequence(0, mx), named_struct('a', a0, 'ssr', cast(array() as array<double>)), (st, k) -> "
             + let(_eliminated("st.a", "k"), "b", "named_struct('a', b, 'ssr', concat(st.ssr, array(b[mx + 1][mx + 1])))") + ").ssr")
    aic = "transform(ssr, (v, p) -> named_struct('aic', if(v > 0, (size(dx) - mx) * ln(v / (size(dx) - mx)) + 2 * (p + 2), cast(null as double)), 'p', p))"
    chosen = let(_products(wide), "a0", let(sweep, "ssr", f"array_min(filter({aic}, q -> q.aic is not null)).p"))
    narrow = f"concat({lagged('p')}, {level('p')}, {now('p')})"
    swept = let(_products(narrow), "a1", f"aggregate({rng('0', 'p - 1')}, a1, (a, k) -> {_eliminated('a', 'k')})")
    left = "(c[p + 1][p + 1] - c[p][p + 1] * c[p][p + 1] / nullif(c[p][p], 0D))"
    stat = f"c[p][p + 1] / nullif(c[p][p], 0D) / nullif(sqrt({left} / nullif(size(dx) - 2 * p - 2, 0) / nullif(c[p][p], 0D)), 0D)"
    final = let(chosen, "p", f"if(p is null, null, {let(swept, 'c', f'''named_struct('stat', {stat}, 'lags', p, 'nobs', size(dx) - p)''')})")
    return let(f"transform(sequence(1, size({ys}) - 1), i -> {ys}[i] - {ys}[i - 1])", "dx", let(limit, "mx", f"if(mx < 0, null, {final})"))


def p_value(stat: str) -> str:
    """Normal distribution function of the response polynomial, by its odd power series."""
    z = f"if({stat} <= {TURN}D, {polynomial(SMALL, stat)}, {polynomial(LARGE, stat)})"
    series = "aggregate(sequence(1, 200), named_struct('s', z, 't', z), (m, k) -> named_struct('s', m.s + m.t * z * z / (2 * k + 1), 't', m.t * z * z / (2 * k + 1))).s"
    phi = let(z, "z", f"if(z < -8, 0D, if(z > 8, 1D, 0.5D + exp(-z * z / 2) / sqrt(2 * pi()) * {series}))")
    return f"if({stat} > {MOST}D, 1D, if({stat} < {LEAST}D, 0D, {phi}))"


def augmented_dickey_fuller(series: DataFrame, col: str = "y") -> DataFrame:
    """Statistic, lag, rows, p-value and critical values of every series; of
    its first difference too; order d: 0 where the unit root is rejected at 5 %,
    else 1 (the study stops there).  Series too short or constant give nulls and d = 1."""
    a = series_arrays(series, col).where("n >= 4")
    a = a.withColumn("r", F.expr(adf_struct("ys"))).withColumn("dy", F.expr("transform(sequence(1, n - 1), i -> ys[i] - ys[i - 1])"))
    a = a.withColumn("r1", F.expr(adf_struct("dy"))).select("series_id", "r", "r1")
    a = a.withColumns({"p": F.expr(p_value("r.stat")), "p1": F.expr(p_value("r1.stat"))})
    rows = "(1D / r.nobs)"
    root = F.coalesce(F.col("p") < LEVEL, F.lit(False))
    return a.select(
        "series_id", rnd(F.col("r.stat"), 6).alias("adf_stat"), F.col("r.lags").cast("bigint").alias("adf_lags"),
        F.col("r.nobs").cast("bigint").alias("adf_nobs"), rnd(F.col("p"), 6).alias("adf_pvalue"),
        *[rnd(F.expr(polynomial(c, rows)), 6).alias(f"adf_crit{k}") for k, c in CRITICAL.items()], root.alias("estacionaria"),
        rnd(F.col("r1.stat"), 6).alias("adf_stat_d1"), rnd(F.col("p1"), 6).alias("adf_pvalue_d1"),
        F.when(root, 0).otherwise(1).cast("bigint").alias("d"))
