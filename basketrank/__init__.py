"""Two-stage retail recommendations as Spark DataFrame jobs."""
