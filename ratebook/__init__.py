"""Contract rate analytics as Spark DataFrame and Structured Streaming jobs."""
