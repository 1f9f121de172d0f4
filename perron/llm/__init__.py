"""Operators for training data: deduplication, filters, mixing, packing and token files."""
