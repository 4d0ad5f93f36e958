"""Operators for training-data pipelines: search, packing, deduplication, scanning and scoring of whole texts."""
