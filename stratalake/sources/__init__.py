"""Readers and writers: CSV scans, the layer store, relational tables, shared staging."""
