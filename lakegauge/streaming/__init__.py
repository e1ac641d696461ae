"""Structured Streaming jobs: landing, cleaning with dedup, hourly statistics."""
