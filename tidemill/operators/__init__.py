"""Batch operators: trends, corpus, profile, features, lookups, evaluation, monitoring, trials, models."""
