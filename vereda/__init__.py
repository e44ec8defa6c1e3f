"""Market-indicator analytics as Spark DataFrame jobs."""
