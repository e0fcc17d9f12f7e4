"""SQL twins of the registered queries, for an independent check in DuckDB."""
