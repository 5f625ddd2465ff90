"""Operators: each takes DataFrames and returns a DataFrame, or commits a collection version."""
