"""Urban ticket analytics as Spark DataFrame operations."""
