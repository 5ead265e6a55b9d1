"""Query plans: report queries, the medallion pipeline and the catalogue of
registered queries with their DuckDB oracle SQL."""
