"""Structured Streaming jobs; the same plans as in batch."""
