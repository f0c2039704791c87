"""Column functions: every one returns a Column built from Spark's own expressions."""
