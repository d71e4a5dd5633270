"""Parts of a file path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix(name: Column) -> Column:
    """Last dot and what follows; empty for dotfiles, names without extension and names ending in a dot."""
    return F.regexp_extract(name, r"(?s)\A.+(\.[^.]+)\z", 1)


def stem(name: Column) -> Column:
    return F.left(name, F.length(name) - F.length(suffix(name)))


def extension(name: Column) -> Column:
    return F.lower(suffix(name))
