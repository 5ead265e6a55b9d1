"""Incremental ingest with Structured Streaming."""

from .page_ingest import PAGE_SCHEMA, assembled, start_page_ingest

__all__ = ["PAGE_SCHEMA", "assembled", "start_page_ingest"]
