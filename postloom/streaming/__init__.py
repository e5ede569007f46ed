"""Structured Streaming forms of ingest, deduplication, usage and enrichment."""
