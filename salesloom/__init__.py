"""Sales analytics on Spark: a star schema, versioned tables and read-only SQL."""
