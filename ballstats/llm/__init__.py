"""Operators for preparing training text: fingerprints, packing, deduplication, search, scoring, filters."""
