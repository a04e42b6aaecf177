"""Operators for building training data from text tables; nothing else in the library imports them."""
