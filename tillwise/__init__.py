"""Commerce revenue analytics expressed as Spark DataFrame, MLlib and streaming jobs."""
