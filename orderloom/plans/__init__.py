"""Whole runs: nightly load, historical backfill, B2B reports, and the query catalogue."""
