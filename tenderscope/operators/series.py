"""Monthly series preparation and descriptive statistics.

The reference studies one series on the driver.  Here every operator is keyed
by ``series_id`` and runs all series in one job: windows are partitioned by
the series (at most #months rows each), aggregates group by it.  A series
frame has columns ``series_id, mes, y`` (``y`` double, null = no data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from .util import rnd

from .util import materialize, month_seq


def series_frame(fact: DataFrame, key: str | None = None, value: str = "valor") -> DataFrame:
    """Monthly totals per series; ``key=None`` → one series ``total``."""
    sid = F.lit("total") if key is None else F.col(key).cast("string")
    g = fact.groupBy(sid.alias("series_id"), "mes").agg(F.sum(value).alias("_v"))
    return g.select("series_id", "mes", F.col("_v").cast("double").alias("y"))


def sorted_quantile(arr, q: float):
    """Linear-interpolated quantile of a sorted, null-free array column:
    h = (n−1)q, lo + (hi − lo)(h − ⌊h⌋) (pandas / numpy ``linear``).  Used on
    one series' values (bounded by the calendar), gathered per group."""
    a = F.col(arr) if isinstance(arr, str) else arr
    h = (F.size(a) - 1) * F.lit(float(q))
    lo = F.try_element_at(a, (F.floor(h) + 1).cast("int"))
    hi = F.try_element_at(a, (F.ceil(h) + 1).cast("int"))
    return lo + (hi - lo) * (h - F.floor(h))


def _w():
    return Window.partitionBy("series_id").orderBy("mseq")


def gap_free(series: DataFrame) -> DataFrame:
    """Each series on its own monthly range (first → last month with data);
    missing months are rows with ``y`` null.  Each month row expands to
    itself plus the empty months before the series' next month (``lead`` +
    ``explode(sequence)``): one window pass, no join and no bounds aggregate."""
    w = Window.partitionBy("series_id").orderBy("mes")
    nxt = F.lead("mes").over(w)
    s = series.where(F.col("mes").isNotNull()).select("series_id", "mes", "y", nxt.alias("_nx"))
    upto = F.when(F.col("_nx").isNull(), F.col("mes")).otherwise(F.add_months("_nx", -1))
    e = s.select("series_id", "mes", "y", F.explode(F.sequence("mes", upto, F.expr("interval 1 month"))).alias("_m"))
    return e.select("series_id", F.col("_m").alias("mes"), month_seq("_m").alias("mseq"),
                    F.when(F.col("_m") == F.col("mes"), F.col("y")).alias("y"))


def filled(series: DataFrame) -> DataFrame:
    """The gap-free, interpolated series as (series_id, mes, mseq, y): what the
    study hands to decomposition, correlation and stationarity checks."""
    return interpolate_linear(series).select("series_id", "mes", "mseq", F.col("y_interp").alias("y"))


def missing_months(series: DataFrame) -> DataFrame:
    """Months and missing months per series."""
    g = gap_free(series)
    return g.groupBy("series_id").agg(F.count(F.lit(1)).alias("meses"), F.count_if(F.col("y").isNull()).alias("meses_faltantes"))


def interpolate_linear(series: DataFrame) -> DataFrame:
    """Linear interpolation over missing months by month position; gaps
    before the first value stay null, gaps after the last value take it."""
    s = series.where(F.col("mes").isNotNull())
    # one row per series holds its known values; the stretches between them are laid out from it,
    # so nothing is sorted after it grew.  Small rows that grow are dealt over all tasks, not merged into few
    tasks = int(s.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = s.select("series_id", "mes", F.col("y").cast("double").alias("y")).repartition(tasks, "series_id").groupBy("series_id").agg(
        F.min("mes").alias("lo"), F.max("mes").alias("hi"),
        F.sort_array(F.collect_list(F.when(F.col("y").isNotNull(), F.struct("mes", "y")))).alias("k"))
    stretches = """concat(
        if(size(k) > 0 and k[0].mes <= lo, cast(array() as array<struct<m0: date, m1: date, v0: double, next: date, v1: double>>),
           array(named_struct('m0', lo, 'm1', if(size(k) > 0, add_months(k[0].mes, -1), hi), 'v0', cast(null as double), 'next', cast(null as date), 'v1', cast(null as double)))),
        transform(k, (p, i) -> named_struct('m0', p.mes, 'm1', if(i + 1 < size(k), add_months(k[i + 1].mes, -1), hi), 'v0', p.y,
                                            'next', if(i + 1 < size(k), k[i + 1].mes, null), 'v1', if(i + 1 < size(k), k[i + 1].y, null))))"""
    st = a.select("series_id", F.explode(F.expr(stretches)).alias("s")).select("series_id", "s.*")
    g = st.select("*", F.explode(F.sequence("m0", "m1", F.expr("interval 1 month"))).alias("mes"), month_seq("m0").alias("_s0"), month_seq("next").alias("_s1"))
    g = g.select("*", month_seq("mes").alias("mseq"), F.when(F.col("mes") == F.col("m0"), F.col("v0")).alias("y"))
    interp = (F.when(F.col("y").isNotNull(), F.col("y"))
              .when(F.col("v0").isNull(), F.lit(None))
              .when(F.col("v1").isNull(), F.col("v0"))
              .otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("mseq") - F.col("_s0")) / (F.col("_s1") - F.col("_s0"))))
    return g.select("series_id", "mes", "mseq", "y", interp.alias("y_interp"))


def describe(series: DataFrame, col: str = "y") -> DataFrame:
    """Count, mean, std (n−1), min, quartiles (linear), max per series.
    ``percentile`` buffers one series (≤ #months values) per group."""
    a = series.groupBy("series_id").agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.sort_array(F.collect_list(col)).alias("_s"), F.max(col).alias("max"))
    r2 = lambda c: rnd(c, 2)
    return a.select("series_id", "count", r2("mean").alias("mean"), r2("std").alias("std"), r2("min").alias("min"),
                    r2(sorted_quantile("_s", 0.25)).alias("p25"), r2(sorted_quantile("_s", 0.5)).alias("p50"),
                    r2(sorted_quantile("_s", 0.75)).alias("p75"), r2("max").alias("max"))


def summary(series: DataFrame) -> DataFrame:
    """E5: span, count, mean, std (n−1), coefficient of variation of the
    interpolated series."""
    i = interpolate_linear(series)
    a = i.groupBy("series_id").agg(
        F.min("mes").alias("inicio"), F.max("mes").alias("fim"), F.count("y_interp").alias("observacoes"),
        F.avg("y_interp").alias("_m"), F.stddev_samp("y_interp").alias("_s"))
    return a.select("series_id", "inicio", "fim", "observacoes", rnd("_m", 2).alias("media"), rnd("_s", 2).alias("desvio"),
                    rnd(F.try_divide(F.col("_s"), F.col("_m")), 6).alias("cv"))


def month_of_year_means(series: DataFrame) -> DataFrame:
    """Mean by month of year, the mean of those means, and the peak month
    (first month on ties)."""
    i = interpolate_linear(series)
    m = i.groupBy("series_id", F.month("mes").alias("mes_ano")).agg(F.avg("y_interp").alias("_mm"))
    s = m.groupBy("series_id").agg(F.avg("_mm").alias("_g"), F.max_by("mes_ano", F.struct(F.col("_mm"), -F.col("mes_ano"))).alias("mes_pico"))
    j = m.join(s, on="series_id")
    return j.select("series_id", F.col("mes_ano").cast("bigint").alias("mes_ano"), rnd("_mm", 2).alias("media_mes"),
                    rnd("_g", 2).alias("media_geral"), F.col("mes_pico").cast("bigint").alias("mes_pico"))


def box_by_year(series: DataFrame) -> DataFrame:
    """Per series and year: quartiles, whiskers at the last point within
    1.5·IQR of the box, and the number of outliers."""
    i = interpolate_linear(series).where(F.col("y_interp").isNotNull()).select("series_id", F.year("mes").alias("ano"), F.col("y_interp").alias("v"))
    q = i.groupBy("series_id", "ano").agg(F.sort_array(F.collect_list("v")).alias("_s"))
    q = q.select("series_id", "ano", sorted_quantile("_s", 0.25).alias("q1"), sorted_quantile("_s", 0.5).alias("mediana"),
                 sorted_quantile("_s", 0.75).alias("q3"))
    j = i.join(q, on=["series_id", "ano"])
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    a = j.groupBy("series_id", "ano", "q1", "mediana", "q3").agg(
        F.min(F.when(F.col("v") >= lo, F.col("v"))).alias("bigode_inf"),
        F.max(F.when(F.col("v") <= hi, F.col("v"))).alias("bigode_sup"),
        F.count_if((F.col("v") < lo) | (F.col("v") > hi)).alias("outliers"))
    r2 = lambda c: rnd(c, 2)
    return a.select("series_id", F.col("ano").cast("bigint").alias("ano"), r2("q1").alias("q1"), r2("mediana").alias("mediana"),
                    r2("q3").alias("q3"), r2("bigode_inf").alias("bigode_inf"), r2("bigode_sup").alias("bigode_sup"), "outliers")


def replace_outlier(series: DataFrame, month: int = 7, year: int | None = None) -> DataFrame:
    """Replace the value of ``month``/``year`` (default: that month of the
    series' first year) by the median of the same calendar month in the other
    years."""
    i = interpolate_linear(series).select("series_id", "mes", "mseq", F.col("y_interp").alias("y"))
    first = i.groupBy("series_id").agg(F.year(F.min("mes")).alias("_y0"))
    i = i.join(first, on="series_id")
    target_year = F.lit(year) if year is not None else F.col("_y0")
    is_target = (F.month("mes") == month) & (F.year("mes") == target_year)
    med = i.where((F.month("mes") == month) & ~is_target & F.col("y").isNotNull()).groupBy("series_id").agg(
        sorted_quantile(F.sort_array(F.collect_list("y")), 0.5).alias("_med"))
    j = i.join(med, on="series_id", how="left")
    return j.select("series_id", "mes", "mseq", F.when(is_target & F.col("_med").isNotNull(), F.col("_med")).otherwise(F.col("y")).alias("y"))


def trim_incomplete(series: DataFrame) -> DataFrame:
    """Drop the last calendar year of each series when it has fewer than
    12 months."""
    s = series.withColumn("_ano", F.year("mes"))
    last = s.groupBy("series_id").agg(F.max("_ano").alias("_ult"))
    cnt = s.groupBy("series_id", "_ano").agg(F.count(F.lit(1)).alias("_n"))
    bad = cnt.join(last, on="series_id").where((F.col("_ano") == F.col("_ult")) & (F.col("_n") < 12)).select("series_id", "_ano")
    return s.join(bad, on=["series_id", "_ano"], how="left_anti").drop("_ano")


def first_difference(series: DataFrame, col: str = "y") -> DataFrame:
    """Y − lag(y); the first row of each series is dropped."""
    s = series.withColumn("mseq", month_seq("mes")) if "mseq" not in series.columns else series
    d = s.select("series_id", "mes", "mseq", (F.col(col) - F.lag(col).over(_w())).alias("dy"))
    return d.where(F.col("dy").isNotNull())


def cleaned(fact: DataFrame, key: str | None = None) -> DataFrame:
    """The modelling series of the study: interpolate, replace the July
    outlier of the first year, drop the incomplete last year.  The result
    monthly series (#series × #months rows) is checkpointed after the big
    aggregation and again once cleaned: the fits above read it many times."""
    return materialize(trim_incomplete(replace_outlier(materialize(series_frame(fact, key)))))
