"""Incremental file-stream ingest into bronze tables."""
