"""Column expressions: text, calendar, measures and semi-structured access."""
