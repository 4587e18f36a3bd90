"""Origin-destination analytics as Spark jobs."""
