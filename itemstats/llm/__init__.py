"""Operators for training-data pipelines: near-duplicates, extraction, packing, sharding and the like."""
