"""Operators for large training-data pipelines: deduplication, filters, extraction, packing."""
