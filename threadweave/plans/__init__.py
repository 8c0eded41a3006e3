"""Reports, the query catalog and its DuckDB oracle SQL."""
