"""Readers and writers: record dumps, table views, the stored index."""
