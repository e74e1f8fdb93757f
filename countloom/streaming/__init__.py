"""Structured Streaming forms of operators that also run in batch."""
