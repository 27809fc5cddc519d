"""Structured Streaming form of the monthly load."""
