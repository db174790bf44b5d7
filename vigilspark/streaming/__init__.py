"""Structured Streaming jobs over event messages."""
