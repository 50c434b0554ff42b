"""Structured Streaming jobs: ingest, deduplication and live aggregates."""
