"""Structured Streaming forms of cleaning, blocking, scoring and entropy."""
