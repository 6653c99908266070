"""Query catalogue: Spark builders and their DuckDB oracle SQL."""
