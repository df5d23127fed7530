"""Operators on documents for training data; their queries are in ``queries``."""
