"""Sources and sinks: the driver's parquet tables, the item fact built from
them, landed API pages, JSON/CSV files and layered table writes."""

from .tables import expenses, fact, headers, read_table

__all__ = ["expenses", "fact", "headers", "read_table"]
