"""Queries over the given tables and the SQL each one must agree with."""
