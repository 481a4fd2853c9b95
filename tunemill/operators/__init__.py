"""Operators: each takes and returns DataFrames (see the modules)."""
