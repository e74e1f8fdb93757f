"""Readers of text formats, as lazily planned DataFrames."""
