"""Structured Streaming forms of scoring, de-duplication and upsert."""
