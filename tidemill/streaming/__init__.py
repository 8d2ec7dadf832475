"""Structured Streaming building blocks."""
