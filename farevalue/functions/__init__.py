"""Column builders: native Spark SQL expressions only."""
