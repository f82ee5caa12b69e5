"""Incremental arrival of raw files."""
