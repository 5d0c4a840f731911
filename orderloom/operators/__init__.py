"""DataFrame-to-DataFrame operators the reports and the ingestion share."""
