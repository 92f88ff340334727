"""Structured Streaming forms of the cost log and of arriving documents (our extension)."""
