"""Structured Streaming entry points for the incremental loads."""
