"""Relational building blocks: projection, dedupe, lag, summaries, joins and checks."""
