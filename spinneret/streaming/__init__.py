"""Structured Streaming forms of the index build, visited set and retry state."""
