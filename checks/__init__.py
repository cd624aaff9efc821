"""Queries that show every operator on the given tables, with the same result in plain SQL."""
