"""Independent ANSI SQL for every registered query, run by DuckDB on the same tables."""
