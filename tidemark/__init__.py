"""Customer-retention analytics as Spark DataFrame jobs."""
