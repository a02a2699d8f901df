"""Structured Streaming: ingest with dead letters, and event-time operators."""
