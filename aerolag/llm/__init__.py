"""Operators for training data: scoring, formatting, scanning, deduplication and packing."""
