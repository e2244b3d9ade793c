"""Incremental forms of ingestion, deduplication and daily metrics."""
