"""Whole jobs, shared storage, and the registered queries with their SQL equivalents."""
