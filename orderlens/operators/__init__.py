"""Relational operators of the order model, as DataFrame plans."""
