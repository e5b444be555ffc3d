"""Incremental arrival of record dumps."""
