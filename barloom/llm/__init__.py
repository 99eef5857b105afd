"""Operators of a training-data pipeline: filtering, deduplication, scans and packing of documents."""
