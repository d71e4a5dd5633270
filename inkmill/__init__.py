"""Spark-native preparation of document collections as clean, checked Markdown."""

__version__ = "0.1.0"
