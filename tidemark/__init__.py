"""Time-series analytics as Spark DataFrame operators."""
