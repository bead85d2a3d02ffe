"""Column expressions. All are native Spark expressions; none is a Python UDF."""
