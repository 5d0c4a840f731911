"""Column-level helpers, all built from Spark's own functions."""
