"""Description cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(col) -> Column:
    """null → ``""``; lower case; every char that is not a letter, digit,
    underscore or whitespace becomes a space; runs of whitespace collapse to one
    space; trim.  Unicode-aware: accented letters are word characters."""
    c = F.col(col) if isinstance(col, str) else col
    lowered = F.lower(F.coalesce(c, F.lit("")))
    # one pass: a run of non-word characters (punctuation and whitespace
    # alike) becomes a single space — the same result as replacing
    # punctuation by spaces and then collapsing whitespace runs
    return F.trim(F.regexp_replace(lowered, r"[^\p{L}\p{N}_]+", " "))
