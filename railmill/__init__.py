"""railmill: train-running analytics as Spark DataFrame and streaming jobs."""
