"""Structured Streaming forms of the incremental load."""
