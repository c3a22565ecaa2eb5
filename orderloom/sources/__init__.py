"""Landed files and control rows as DataFrames."""
