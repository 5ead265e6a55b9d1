"""Presentation values in pt-BR (D6, C-d)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from ..operators.util import rnd

# Fixed values (must equal the model's pt-BR culture output).
MONTH_NAMES_PT = [
    "janeiro", "fevereiro", "março", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]
MONTH_ABBR_PT = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
# Sunday first, matching dayofweek() = 1 for Sunday.
WEEKDAYS_PT = [
    "domingo", "segunda-feira", "terça-feira", "quarta-feira",
    "quinta-feira", "sexta-feira", "sábado",
]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_name_pt(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES_PT]), _c(month))


def month_abbr_pt(month) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR_PT]), _c(month))


def weekday_pt(date) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS_PT]), F.dayofweek(_c(date)))


def brl_number(x) -> Column:
    """``1234567.891`` → ``1.234.567,89`` (round half-up first: format_number
    alone rounds half-even)."""
    s = F.format_number(rnd(_c(x).cast("double"), 2), 2)
    return F.translate(s, ",.", ".,")


def brl_compact(x) -> Column:
    """``R$ 1,23 bi`` / ``mi`` / ``mil`` steps, else plain ``R$ 999,99``."""
    v = _c(x).cast("double")
    return (
        F.when(v >= 1e9, F.concat(F.lit("R$ "), brl_number(v / 1e9), F.lit(" bi")))
        .when(v >= 1e6, F.concat(F.lit("R$ "), brl_number(v / 1e6), F.lit(" mi")))
        .when(v >= 1e3, F.concat(F.lit("R$ "), brl_number(v / 1e3), F.lit(" mil")))
        .otherwise(F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), F.lit("R$ "), brl_number(F.abs(v))))
    )
