"""Structured Streaming forms of the daily poll."""
