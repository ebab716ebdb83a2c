"""Operators for training-data pipelines over texts; nothing else in the library imports this package."""
