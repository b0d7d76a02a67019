"""Readers, writers, payload parsers and incremental loads."""
