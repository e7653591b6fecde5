"""Structured Streaming runs of the incremental steps."""
