"""Risk-to-action analytics as composable Spark DataFrame operators."""
