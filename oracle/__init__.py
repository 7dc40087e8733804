"""Independent SQL formulations (DuckDB dialect) of the registered queries."""
