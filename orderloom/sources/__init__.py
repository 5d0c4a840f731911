"""Readers and writers: CSV files, message topics, catalog tables."""
