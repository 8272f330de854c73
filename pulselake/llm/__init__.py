"""Operators for training-data pipelines: encoding, deduplication, classification and mixing of documents."""
