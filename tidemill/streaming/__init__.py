"""Structured Streaming twins of the batch trend operators."""
