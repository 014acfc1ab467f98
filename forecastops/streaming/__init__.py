"""Windowed monitors and incremental refresh on Structured Streaming."""
