"""Product-catalog analytics expressed as Spark jobs."""
