"""Operators for training-data pipelines, each a DataFrame -> DataFrame function."""
