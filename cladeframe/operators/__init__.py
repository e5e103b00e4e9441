"""Operators on DataFrames, one module per subject."""
