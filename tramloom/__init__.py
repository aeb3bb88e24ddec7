"""Transit travel-time analytics as Spark DataFrame operators."""
