"""Job compositions, runnable programs, the query registry and its DuckDB oracle SQL."""
