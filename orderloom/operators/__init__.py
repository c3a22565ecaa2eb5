"""Transforms: DataFrames in, DataFrames out, no actions."""
