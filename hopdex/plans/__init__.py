"""Whole queries over the given tables, with the SQL that states the same result."""
