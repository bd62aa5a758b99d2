"""Multi-value XML records to wide tables, as Spark DataFrame jobs."""
