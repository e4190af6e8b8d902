"""Incremental category trend."""
