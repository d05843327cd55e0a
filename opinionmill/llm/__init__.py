"""Operators for preparing training data at scale: filters, deduplication, search, tokens, packing."""
