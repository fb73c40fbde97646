"""Structured Streaming entry to the result store."""
