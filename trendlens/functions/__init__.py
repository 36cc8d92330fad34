"""Column-level building blocks (built-in Spark SQL expressions only)."""
