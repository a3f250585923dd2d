"""Trend, corpus, feature and evaluation jobs written as ``DataFrame -> DataFrame`` functions."""

__version__ = "0.1.0"
