"""Data-quality checks compiled into aggregations."""
