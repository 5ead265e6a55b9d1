"""Calendar dimension (C-a … C-g) and the monthly spine.

The calendar is derived from the fact's first and last month, so it is a tiny
frame (one row per day or month of the covered period) however large the
fact is: it is generated with ``sequence`` + ``explode`` from a one-row
aggregate, never collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fmt import month_abbr_pt, month_name_pt, weekday_pt


def bounds(frame: DataFrame, date_col: str = "mes", end: str = "edate7", monthly: bool = True) -> DataFrame:
    """One row ``(d0, d1)``: 1 Jan of the first year → EDATE(last month, 7)
    (model form, ``end='edate7'``) or 31 Dec of the last year (``end='year'``).

    From the fact (``monthly=False``) only the date column is read.  From a
    monthly aggregate, min/max run over a struct of its columns: Catalyst would
    otherwise drop the aggregate below and scan the raw rows a second time."""
    if monthly:
        whole = F.struct(F.col(date_col).alias("d"), *[F.col(f"`{c}`") for c in frame.columns if c != date_col])
        b = frame.agg(F.min(whole)["d"].alias("_lo"), F.max(whole)["d"].alias("_hi"))
    else:
        b = frame.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    d0 = F.trunc("_lo", "year")
    if end == "year":
        d1 = F.make_date(F.year("_hi"), F.lit(12), F.lit(31))
    elif end == "edate7":
        d1 = F.add_months("_hi", 7)
    elif end == "last":
        d1 = F.col("_hi")
    else:
        raise ValueError(f"unknown calendar end {end!r}")
    return b.select(d0.alias("d0"), d1.alias("d1")).where(F.col("d0").isNotNull())


def calendar(fact: DataFrame, end: str = "edate7", date_col: str = "mes") -> DataFrame:
    """Daily calendar with the model's attributes."""
    b = bounds(fact, date_col, end, monthly=False)
    days = b.select(F.explode(F.sequence("d0", "d1", F.expr("interval 1 day"))).alias("Date"))
    d = F.col("Date")
    q = F.quarter(d)
    return days.select(
        d,
        F.year(d).alias("Ano"),
        F.month(d).alias("Mes"),
        month_name_pt(F.month(d)).alias("NomeMes"),
        month_abbr_pt(F.month(d)).alias("NomeMesAbrev"),
        F.concat(month_abbr_pt(F.month(d)), F.lit("/"), F.year(d).cast("string")).alias("MesAno"),
        (F.year(d) * 100 + F.month(d)).alias("MesAnoNumero"),
        F.concat(F.lit("T"), q.cast("string")).alias("Trimestre"),
        F.concat(F.year(d).cast("string"), F.lit(" T"), q.cast("string")).alias("AnoTrimestre"),
        F.trunc(d, "MM").alias("InicioMes"),
        F.last_day(d).alias("FimMes"),
        weekday_pt(d).alias("DiaSemana"),
        # automatic date hierarchy (Ano > Trimestre > Mês > Dia)
        F.concat(F.lit("Qtr "), q.cast("string")).alias("QuarterLabel"),
        ((F.month(d) + 2) / 3).cast("int").alias("QuarterNo"),
        F.dayofmonth(d).alias("Dia"),
    )


def month_spine(monthly: DataFrame, end: str = "edate7", date_col: str = "mes") -> DataFrame:
    """One row per calendar month (first day) in the calendar's range."""
    b = bounds(monthly, date_col, end)
    return b.select(F.explode(F.sequence(F.trunc("d0", "MM"), F.trunc("d1", "MM"), F.expr("interval 1 month"))).alias(date_col))


def month_windows(spark, y0: int, y1: int) -> DataFrame:
    """One row per month of years y0..y1 with first/last day (``dd/MM/yyyy``)
    and label (``MM/yyyy``) — the request windows of the paged pull."""
    return month_windows_from(spark.range(1).select(F.lit(y0).alias("y0"), F.lit(y1).alias("y1")))


def month_windows_from(years: DataFrame) -> DataFrame:
    """S1 over a frame of ``(y0, y1)`` year ranges (one row per pull)."""
    base = years.select(
        F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)),
                             F.make_date("y1", F.lit(12), F.lit(1)),
                             F.expr("interval 1 month"))).alias("d")
    )
    return base.select(
        F.date_format("d", "dd/MM/yyyy").alias("data_inicial"),
        F.date_format(F.last_day("d"), "dd/MM/yyyy").alias("data_final"),
        F.date_format("d", "MM/yyyy").alias("mes_ano"),
    )


# The movable feasts of the study's country, in days from Easter.
FEASTS = {"carnaval": (-48, -47), "sexta_feira_santa": (-2,), "corpus_christi": (60,)}


def easter(year: str, quotient: str = "div") -> str:
    """SQL date of Easter Sunday for the integer expression ``year``, by the
    anonymous Gregorian computus: days from 22 March to the paschal full moon
    (``moon``), to the Sunday after it, less a week in the late cases.
    ``quotient`` is the engine's integer division."""
    q = quotient
    gold, cent, rest = f"({year} % 19)", f"({year} {q} 100)", f"({year} % 100)"
    moon = f"((19 * {gold} + {cent} - {cent} {q} 4 - (({cent} - (({cent} + 8) {q} 25) + 1) {q} 3) + 15) % 30)"
    sunday = f"((32 + 2 * ({cent} % 4) + 2 * ({rest} {q} 4) - {moon} - {rest} % 4) % 7)"
    late = f"(({gold} + 11 * {moon} + 22 * {sunday}) {q} 451)"
    return f"(make_date({year}, 3, 22) + CAST({moon} + {sunday} - 7 * {late} AS INT))"


def feast_days(month: str, year: str, quotient: str = "div") -> dict[str, str]:
    """SQL count of each movable feast's days in the month."""
    day = easter(year, quotient)
    return {name: "(" + " + ".join(f"CASE WHEN month({day} + CAST({d} AS INT)) = {month} THEN 1 ELSE 0 END" for d in days) + ")" for name, days in FEASTS.items()}
