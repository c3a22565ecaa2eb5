"""Retail order analytics as Spark jobs: sources, transforms, checks and keyed loads."""
