"""Operators for training-data corpora: archives, filters, deduplication, tokens."""
