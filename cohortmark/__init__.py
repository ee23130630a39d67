"""Group-discriminating marker analytics as plain DataFrame functions."""
