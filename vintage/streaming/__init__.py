"""Incremental ingest by file arrival."""
