"""Column functions: every helper takes and returns ``Column`` objects so that
the expressions stay inside whole-stage codegen (no Python UDFs)."""

from .dax import bsub, distinct_count_blank, div
from .fmt import brl_compact, brl_number, month_name_pt, month_abbr_pt, weekday_pt
from .parse import parse_br, parse_decimal_comma, parse_loose, parse_month
from .text import clean_text

__all__ = [
    "bsub", "distinct_count_blank", "div",
    "brl_compact", "brl_number", "month_name_pt", "month_abbr_pt", "weekday_pt",
    "parse_br", "parse_decimal_comma", "parse_loose", "parse_month",
    "clean_text",
]
