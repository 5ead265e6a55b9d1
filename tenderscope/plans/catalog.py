"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from . import q_dashboard, q_detail, q_forecast, q_ingest, q_measures, q_models, q_prep, q_series, q_text  # noqa: F401
from .registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
