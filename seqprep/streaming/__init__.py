"""Operators over event streams."""
