"""Queries over the supplied tables, each with an equivalent SQL text."""
