"""Structured Streaming forms of ingest, upsert and de-duplication."""
