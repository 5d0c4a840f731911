"""Star schema, reports and the small relational plans."""
