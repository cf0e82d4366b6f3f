"""Operators on DataFrames, one module per area."""
