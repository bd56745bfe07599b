"""Operators for training-data pipelines: scoring, sharding, near-duplicates, token output, packing."""
