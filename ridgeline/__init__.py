"""A Spark-first engine for line-shaped geographic data."""
