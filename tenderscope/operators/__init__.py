"""Relational operators of the procurement model, all DataFrame → DataFrame."""
