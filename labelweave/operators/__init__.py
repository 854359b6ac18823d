"""Operators: DataFrames in, DataFrames out, keyed by explicit ids."""
