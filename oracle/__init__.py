"""DuckDB reference SQL for every registered query (the correctness oracle)."""
