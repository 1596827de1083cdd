"""tidesync operators."""
