"""brookmart: a real-time shop warehouse written with Spark DataFrames and Structured Streaming."""
