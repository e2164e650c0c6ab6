"""Tweet sentiment analytics as Spark DataFrame jobs."""
