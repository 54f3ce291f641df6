"""Readers, writers, table metadata and the mapping of the given tables."""
