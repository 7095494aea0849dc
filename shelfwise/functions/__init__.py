"""Column-level scalar helpers; all built-in Spark expressions (no UDFs)."""
