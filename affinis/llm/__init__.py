"""Operators for training-data pipelines: duplicates, leaks, secrets, quality, packing, shards, archives."""
