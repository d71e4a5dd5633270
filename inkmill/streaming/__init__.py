"""Continuous conversion of an arriving collection."""
