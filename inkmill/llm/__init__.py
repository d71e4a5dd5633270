"""Operators for preparing training corpora: mixing, filtering, search, deduplication and encoding."""
