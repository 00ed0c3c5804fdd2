"""Post-training data operators as Spark DataFrame jobs."""
