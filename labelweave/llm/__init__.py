"""Operators for preparing language-model training data, their queries and their SQL checks."""
