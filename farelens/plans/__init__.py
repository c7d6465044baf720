"""Query catalog, DuckDB oracle text and the end-to-end study run."""
