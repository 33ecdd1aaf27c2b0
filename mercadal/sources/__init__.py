"""Readers, writers and generators of the feeds."""
