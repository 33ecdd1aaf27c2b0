"""Relational operators Spark does not offer in one call."""
