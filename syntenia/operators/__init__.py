"""Operators: DataFrames in, DataFrames out, no actions inside."""
