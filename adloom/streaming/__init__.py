"""Incremental feeds with Structured Streaming."""
