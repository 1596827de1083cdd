"""tidesync functions."""
