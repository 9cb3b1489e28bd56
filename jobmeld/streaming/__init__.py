"""Structured Streaming forms of landing, first-seen filtering and upsert."""
