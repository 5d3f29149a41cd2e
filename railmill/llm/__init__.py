"""Operators for preparing training corpora: filters, dedup, scoring, mixing, search, encoding."""
