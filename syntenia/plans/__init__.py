"""Composite plans made of operators."""
