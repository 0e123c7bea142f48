"""Structured Streaming versions of ingest and snapshot upkeep."""
