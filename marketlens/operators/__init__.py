"""Transformations: every function takes and returns DataFrames."""
