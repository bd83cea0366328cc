"""The supplied tables seen as basket tables, the registered queries over
them, and the same queries in DuckDB's SQL."""
