"""Marketing-campaign analytics as Spark DataFrame jobs."""
