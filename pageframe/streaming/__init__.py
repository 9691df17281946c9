"""Streams of responses: the same parsing as in batch, on Structured Streaming."""
