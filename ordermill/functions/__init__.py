"""Column expressions, all built-in Spark functions."""
