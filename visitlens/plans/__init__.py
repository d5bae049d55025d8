"""Plans: the end-to-end session job, the query registry and its DuckDB oracle SQL."""
