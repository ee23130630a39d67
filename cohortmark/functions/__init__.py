"""Column expressions over sequences, all built from Spark's own functions."""
