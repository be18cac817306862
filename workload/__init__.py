"""Queries over the given tables, each with its SQL counterpart where one exists."""
