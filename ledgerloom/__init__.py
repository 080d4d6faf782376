"""Customer-transaction analytics as Spark DataFrame jobs."""
