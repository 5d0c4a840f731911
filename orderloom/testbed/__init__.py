"""The driver's parquet tables shaped into the source tables, with queries and oracle SQL."""
