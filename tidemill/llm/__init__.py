"""Operators of a training-data pipeline, each on plain DataFrames."""
