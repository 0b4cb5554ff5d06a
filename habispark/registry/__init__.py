"""Queries over the given tables, one per operator, and the SQL each one is compared with."""
