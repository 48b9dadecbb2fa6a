"""Operators for training-data pipelines: quality, duplicates, contamination, tokens, language."""
