"""Column -> Column building blocks. None of them needs a Python worker."""
