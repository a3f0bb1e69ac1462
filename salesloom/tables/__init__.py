"""Versioned tables: partitioned Parquet files and a commit log."""
