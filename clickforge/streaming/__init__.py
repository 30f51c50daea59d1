"""Structured Streaming jobs (ST1)."""
