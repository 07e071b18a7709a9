"""Operators for preparing training text: dedup, sharding, extraction, filters, tokens, search."""
