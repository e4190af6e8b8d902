"""DuckDB twins of the registered queries."""
