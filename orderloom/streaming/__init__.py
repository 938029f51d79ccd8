"""Structured Streaming loads."""
