"""Structured Streaming forms of the batch operators (same results, incremental input)."""
