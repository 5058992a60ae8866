"""Cloud network traffic analytics as Spark DataFrame operators."""
