"""Street-space analytics as Spark DataFrame operators."""
