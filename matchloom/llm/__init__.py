"""Operators for training-data pipelines over documents; nothing outside imports this package."""
