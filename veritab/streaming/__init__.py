"""Structured Streaming twins of the batch checks."""
