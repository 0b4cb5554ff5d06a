"""Housing analytics as Spark DataFrame operators."""
