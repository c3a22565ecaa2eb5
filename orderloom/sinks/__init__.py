"""Keyed loads into Parquet tables."""
