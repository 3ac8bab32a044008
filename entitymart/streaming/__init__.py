"""Continuous updates with Structured Streaming."""
