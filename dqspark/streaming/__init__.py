"""Metrics over arriving objects and event streams, on Structured Streaming."""
