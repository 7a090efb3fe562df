"""Column expressions. Everything here is built-in Spark SQL, no Python UDFs."""
