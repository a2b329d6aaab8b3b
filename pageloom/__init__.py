"""Document topics and link graphs as Spark DataFrame jobs."""
