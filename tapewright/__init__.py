"""Market-data quality, coverage and bars as Spark DataFrame jobs."""
