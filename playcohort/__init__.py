"""Game-publishing and advertising reports as PySpark DataFrame and Structured Streaming jobs."""
