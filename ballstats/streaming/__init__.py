"""Structured Streaming queries over the same metrics."""
