"""Incremental load with Structured Streaming."""
