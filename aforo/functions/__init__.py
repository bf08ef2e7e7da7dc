"""Column functions, all on built-in Spark expressions."""
