"""Incremental ingest of snapshot files with Structured Streaming."""
