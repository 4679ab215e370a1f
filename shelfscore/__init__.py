"""Search-to-catalogue relevance scoring as Spark DataFrame jobs."""
