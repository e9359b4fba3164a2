"""Structured Streaming: scenes that arrive as files."""
