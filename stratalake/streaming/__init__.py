"""Incremental variants of the row-local steps."""
