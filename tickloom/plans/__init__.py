"""Whole jobs. They start Spark actions; the session always belongs to the caller."""
