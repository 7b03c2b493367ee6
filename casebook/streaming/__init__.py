"""Structured Streaming forms of the batch flows."""
