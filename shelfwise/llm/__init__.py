"""Operators for training-data pipelines, their queries and the check texts."""
