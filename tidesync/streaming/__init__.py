"""tidesync streaming."""
