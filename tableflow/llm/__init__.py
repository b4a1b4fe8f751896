"""Operators for training-data pipelines: quality, extraction, tokens, dedup, search, packing."""
