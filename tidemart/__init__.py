"""Real-time retail warehouse operators on Spark DataFrames and Structured Streaming."""
