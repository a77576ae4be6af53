"""Service-request analytics as Spark DataFrame operators."""
