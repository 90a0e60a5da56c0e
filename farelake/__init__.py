"""farelake: airfare-snapshot collection analytics as Spark jobs."""
