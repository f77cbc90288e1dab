"""Structured Streaming forms of stages."""
