"""Readers: topics, dimensions, route configuration and the sample tables."""
