"""Column functions. Everything here stays a built-in Spark expression."""
