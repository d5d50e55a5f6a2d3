"""Structured Streaming jobs: mentions and incremental conversion."""
