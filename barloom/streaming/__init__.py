"""Incremental ingest as a Structured Streaming file source."""
