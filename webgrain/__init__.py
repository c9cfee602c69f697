"""Web-text and evaluation analytics as composable Spark DataFrame operators."""
