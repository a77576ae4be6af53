"""Structured Streaming versions of ingestion and daily counts."""
