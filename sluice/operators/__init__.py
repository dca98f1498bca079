"""Relational operators: DataFrames in, DataFrames out, no actions on data."""
