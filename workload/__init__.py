"""Queries over the given tables: derived inputs, the queries and their SQL."""
