"""One query per operator over the given tables, and the same computation as SQL."""
