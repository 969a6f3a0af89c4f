"""Registered query plans: each a Spark DataFrame plan plus its DuckDB oracle."""
