"""Operators for text corpora that are to become training data."""
