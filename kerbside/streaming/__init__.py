"""Structured Streaming forms of ingest, dedup and rolling counts."""
