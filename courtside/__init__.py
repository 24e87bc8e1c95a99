"""Game-and-player analytics as Spark DataFrame jobs."""
