"""Structured Streaming forms of the time-driven checks."""
