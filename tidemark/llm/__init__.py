"""Training-data operators: tokenising, filtering, deduplication, mixing and archives, as Spark jobs."""
