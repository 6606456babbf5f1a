"""Creator and channel analytics as Spark DataFrame plans."""
