"""Operators: each takes and returns DataFrames and leaves physical planning to Catalyst."""
