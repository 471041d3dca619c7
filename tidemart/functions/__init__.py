"""Column-level helpers; everything here stays inside Spark's own expressions."""
