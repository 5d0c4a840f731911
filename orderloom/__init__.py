"""Order analytics on Spark: ingestion, star schema and reports as DataFrame plans."""
