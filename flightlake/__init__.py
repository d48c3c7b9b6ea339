"""Daily flight-record analytics on Spark: bronze, silver, enriched and gold tables."""
