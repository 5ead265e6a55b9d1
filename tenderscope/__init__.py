"""tenderscope: procurement analytics expressed as Spark DataFrame/SQL plans.

Sub-packages:
  functions  column-level helpers (parsers, DAX blank rules, text, formats)
  sources    table loaders, the item fact, landed-page ingest, file sinks
  operators  joins, dedup, measures, rankings, time intelligence, series
  plans      report queries, the medallion pipeline, the query catalogue
  streaming  incremental bronze ingest with Structured Streaming
"""

__version__ = "0.1.0"
