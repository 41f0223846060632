"""Station-availability analytics as Spark jobs."""
