"""Column functions: every function takes and returns Spark columns, no Python UDF."""
