"""Structured Streaming jobs, their runner and the stateful processors."""
