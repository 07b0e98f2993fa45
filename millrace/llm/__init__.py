"""Operators for training-data pipelines, each with its query in ``queries``."""
