"""Structured Streaming jobs and stateful processors."""
