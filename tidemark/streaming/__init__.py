"""Incremental forms of the stores on Structured Streaming."""
