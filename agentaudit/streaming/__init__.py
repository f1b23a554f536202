"""Structured Streaming forms of ingest, sampling, metrics and alerts."""
