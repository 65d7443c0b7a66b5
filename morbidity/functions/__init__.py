"""Column functions: every one is built from Spark's own functions, none is a Python UDF."""
