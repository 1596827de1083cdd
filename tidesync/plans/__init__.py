"""tidesync plans."""
