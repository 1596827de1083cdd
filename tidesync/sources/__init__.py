"""tidesync sources."""
