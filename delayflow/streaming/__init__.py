"""Structured Streaming: the same operators on unbounded requests."""
