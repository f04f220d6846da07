"""Incremental Bronze landing with Structured Streaming."""
