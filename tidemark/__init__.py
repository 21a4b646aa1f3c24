"""Entity resolution and record analytics as Spark DataFrame plans."""
