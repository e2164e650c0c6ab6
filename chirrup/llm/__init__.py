"""Operators and queries for training-data pipelines."""
