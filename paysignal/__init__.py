"""Card-payment risk analytics as plain Spark jobs."""
