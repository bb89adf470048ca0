"""Column functions: each takes and returns a Column built from Spark's own expressions."""
