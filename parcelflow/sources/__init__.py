"""Readers of landed files and of relational tables."""
