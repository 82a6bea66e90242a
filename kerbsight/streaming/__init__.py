"""Structured Streaming versions of the count ingest."""
