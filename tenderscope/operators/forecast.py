"""Forecasts and validation.

F1–F4 is the dashboard's linear forecast: a least-squares line through the
13 calendar months ending with the last actual month, evaluated on the months
from the last actual one to the end of the calendar.  Each fit reduces to a
handful of sums per key, so any number of keys (categories, suppliers) is
fitted in one aggregation.  F5–F9 re-aim the study's seasonal model as a
multiplicative trend × month-of-year index, fitted with ``regr_*`` and
grouped averages per series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from .util import rnd

from .calendar import bounds
from .timeintel import monthly_values
from .util import join_on_keys, keys_list, month_seq, with_one_row

# Fixed values of the dashboard model: the interval uses z = 1.645 and a
# fixed sigma of R$ 136,657,638.
# Accuracy labels by MAPE (%): below 20 good, below 35 fair, else limited.
MODEL_Z = 1.645
MODEL_SIGMA = 136657638.0
MAPE_GOOD, MAPE_FAIR = 20, 35
LABEL_GOOD, LABEL_FAIR, LABEL_LIMITED = "BOA", "RAZOÁVEL", "LIMITADA"


def linear_forecast(fact: DataFrame, keys=(), end: str = "edate7") -> DataFrame:
    """columns keys, mes, mseq, valor_total (actual, null if none),
    valor_previsto, plus the fit's ``_sigma`` (residual standard error)."""
    keys = keys_list(keys)
    m = monthly_values(fact, keys).withColumn("v", F.col("v").cast("double"))
    cal = bounds(m, end=end)  # global calendar: one row
    last = m.groupBy(*keys).agg(F.max("mes").alias("_last")) if keys else m.agg(F.max("mes").alias("_last"))
    last = with_one_row(last, cal)
    # training months: the 13 calendar months ending at the key's last month
    train = last.select(*keys, "_last", F.explode(F.sequence(F.greatest(F.add_months("_last", -12), F.col("d0")), F.col("_last"),
                                                             F.expr("interval 1 month"))).alias("mes"))
    train = join_on_keys(train, m, [*keys, "mes"], "left").withColumn("x", month_seq("mes").cast("double"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    t = train.select(*keys, "x", "v", F.avg("x").over(w).alias("mx"), F.avg("v").over(w).alias("my"))
    fit = t.groupBy(*keys).agg(
        F.sum((F.col("x") - F.col("mx")) * (F.coalesce("v", F.lit(0.0)) - F.col("my"))).alias("sxy"),
        F.sum((F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx"))).alias("sxx"),
        F.first("mx").alias("mx"), F.first("my").alias("my"), F.count(F.lit(1)).alias("k"))
    fit = fit.withColumn("slope", F.try_divide("sxy", "sxx")).withColumn("icpt", F.col("my") - F.col("slope") * F.col("mx"))
    res = train.select(*keys, "x", "v")
    res = join_on_keys(res, fit.select(*keys, "slope", "icpt", "k"), keys, "inner")
    sig = res.groupBy(*keys).agg(
        F.sqrt(F.sum(F.pow(F.coalesce("v", F.lit(0.0)) - (F.col("icpt") + F.col("slope") * F.col("x")), 2)) / (F.first("k") - 2)).alias("_sigma"))
    fit = join_on_keys(fit, sig, keys, "left")
    horizon = last.select(*keys, F.explode(F.sequence("_last", F.trunc("d1", "MM"), F.expr("interval 1 month"))).alias("mes"))
    h = join_on_keys(horizon, fit.select(*keys, "slope", "icpt", "_sigma"), keys, "inner")
    h = join_on_keys(h, m, [*keys, "mes"], "left")
    prev = F.greatest(F.lit(0.0), F.col("icpt") + F.col("slope") * month_seq("mes"))
    return h.select(*keys, "mes", month_seq("mes").alias("mseq"), F.col("v").alias("valor_total"),
                    prev.alias("valor_previsto"), "_sigma")


def with_interval(fc: DataFrame, z: float = MODEL_Z, sigma: float | None = MODEL_SIGMA) -> DataFrame:
    """upper = F1 + z·σ, lower = max(0, F1 − z·σ); both blank when F1
    is 0 or blank.  ``sigma=None`` uses the fit's residual standard error."""
    s = F.col("_sigma") if sigma is None else F.lit(float(sigma))
    f = F.col("valor_previsto")
    ok = f.isNotNull() & (f != 0)
    return fc.select("*", F.when(ok, f + z * s).alias("ic_superior"),
                     F.when(ok, F.greatest(F.lit(0.0), f - z * s)).alias("ic_inferior")).drop("_sigma")


def train_test(series: DataFrame, cutoff: str | None = None) -> DataFrame:
    """label each month ``treino`` (≤ cutoff) or ``teste``.  Default cutoff:
    December of the year before the series' last year (test = last year)."""
    s = series
    if cutoff is None:
        last = s.groupBy("series_id").agg(F.max("mes").alias("_m"))
        s = s.join(last, on="series_id").withColumn("_cut", F.make_date(F.year("_m") - 1, F.lit(12), F.lit(1))).drop("_m")
    else:
        s = s.withColumn("_cut", F.lit(cutoff).cast("date"))
    return s.withColumn("conjunto", F.when(F.col("mes") <= F.col("_cut"), F.lit("treino")).otherwise(F.lit("teste"))).drop("_cut")


def _seasonal_fit(train: DataFrame):
    t = train.select("series_id", "mes", "y", month_seq("mes").cast("double").alias("x"), F.month("mes").alias("moy"))
    trend = t.groupBy("series_id").agg(F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a"))
    t = t.join(trend, on="series_id").withColumn("tr", F.col("a") + F.col("b") * F.col("x"))
    idx = t.groupBy("series_id", "moy").agg(F.avg(F.try_divide("y", "tr")).alias("_i"))
    idx = idx.select("series_id", "moy", (F.col("_i") / F.avg("_i").over(Window.partitionBy("series_id"))).alias("idx"))
    fitted = t.join(idx, on=["series_id", "moy"]).select("series_id", "y", (F.col("tr") * F.col("idx")).alias("yhat"))
    sd = fitted.groupBy("series_id").agg(F.stddev_samp(F.col("y") - F.col("yhat")).alias("sd"))
    return trend.join(sd, on="series_id"), idx


def _apply(model, idx, months: DataFrame, z: float) -> DataFrame:
    j = months.join(model, on="series_id").withColumn("moy", F.month("mes"))
    j = j.join(idx, on=["series_id", "moy"], how="left")
    yhat = (F.col("a") + F.col("b") * month_seq("mes")) * F.col("idx")
    return j.select("*", yhat.alias("yhat")).select(
        *[c for c in months.columns], "yhat", (F.col("yhat") - z * F.col("sd")).alias("yhat_lower"),
        (F.col("yhat") + z * F.col("sd")).alias("yhat_upper"))


def seasonal_validation(split: DataFrame, z: float = MODEL_Z) -> DataFrame:
    """F6 (validation): fit on ``treino`` rows, predict the ``teste`` rows."""
    model, idx = _seasonal_fit(split.where(F.col("conjunto") == "treino"))
    return _apply(model, idx, split.where(F.col("conjunto") == "teste").select("series_id", "mes", "y"), z)


def seasonal_future(series: DataFrame, horizon: int = 12, z: float = MODEL_Z) -> DataFrame:
    """F6 (final) + F9: refit on all rows; in-sample fit beside ``horizon``
    future months, flagged ``ajuste`` / ``previsao``."""
    model, idx = _seasonal_fit(series)
    last = series.groupBy("series_id").agg(F.max("mes").alias("_m"))
    fut = last.select("series_id", F.explode(F.sequence(F.add_months("_m", 1), F.add_months("_m", horizon), F.expr("interval 1 month"))).alias("mes"))
    fut = fut.withColumn("y", F.lit(None).cast("double"))
    both = series.select("series_id", "mes", "y").withColumn("tipo", F.lit("ajuste")).unionByName(fut.withColumn("tipo", F.lit("previsao")))
    return _apply(model, idx, both, z)


def raw_metrics(pred: DataFrame) -> DataFrame:
    """MAPE (%), MAE, RMSE on the test months and the accuracy label."""
    e = pred.where(F.col("y").isNotNull())
    a = e.groupBy("series_id").agg(
        (F.avg(F.abs(F.col("y") - F.col("yhat")) / F.abs("y")) * 100).alias("mape"),
        F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("rmse"))
    label = (F.when(F.col("mape") < MAPE_GOOD, F.lit(LABEL_GOOD)).when(F.col("mape") < MAPE_FAIR, F.lit(LABEL_FAIR))
             .otherwise(F.lit(LABEL_LIMITED)))
    return a.select("series_id", "mape", "mae", "rmse", label.alias("acuracia"))


def metrics(pred: DataFrame) -> DataFrame:
    """The same, rounded."""
    return raw_metrics(pred).select("series_id", rnd("mape", 4).alias("mape"), rnd("mae", 2).alias("mae"), rnd("rmse", 2).alias("rmse"), "acuracia")
