"""Text → number / date parsers.

Three number parsers exist because the source data was parsed three different
ways; they disagree on purpose (e.g. ``1.234,56``).  Every parser maps bad
input to null (ANSI mode is on, so ``try_cast`` / ``try_to_date``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_decimal_comma(col) -> Column:
    """``,`` → ``.`` then double; thousands dots are not removed."""
    return F.regexp_replace(_c(col), ",", ".").try_cast("double")


def parse_br(col) -> Column:
    """Brazilian number: drop ``.`` (thousands), ``,`` → ``.``, double."""
    return F.replace(F.replace(_c(col), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def parse_loose(col) -> Column:
    """Keep digits, ``,`` and ``.`` only (the sign is lost), ``,`` → ``.``."""
    kept = F.regexp_replace(_c(col), r"[^0-9,.]", "")
    return F.replace(kept, F.lit(","), F.lit(".")).try_cast("double")


def parse_month(col) -> Column:
    """``MM/yyyy`` → first day of that month; anything else → null."""
    return F.try_to_date(_c(col), "MM/yyyy")
