"""Answer-visibility analytics on Spark."""
