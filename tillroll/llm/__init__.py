"""Operators for preparing training text: filters, mixing, deduplication, scoring and tokens."""
