"""Structured Streaming forms of the alert rules."""
