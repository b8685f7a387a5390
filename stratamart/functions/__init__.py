"""Column expressions of the retail domain, all built from Spark's own functions."""
