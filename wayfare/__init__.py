"""Journey analytics as Spark DataFrame operators."""
