"""Operators of a training-data pipeline: formatting, deduplication, filtering, packing, archives."""
