"""Batch analytics on Spark: raw files to checked, cleaned, historised and summarised tables."""

__version__ = "0.1.0"
