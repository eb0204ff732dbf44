"""Operators of a training-data pipeline over the given documents."""
