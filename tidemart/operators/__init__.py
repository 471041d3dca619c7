"""Functions from DataFrame to DataFrame, usable on tables and, where noted, on streams."""
