"""Operators for preparing training data: search, scoring, deduplication, mixing, formatting."""
