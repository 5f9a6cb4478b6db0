"""Operators for large training-data pipelines (deduplication, scoring, search, mixing, output)."""
