"""Structured Streaming forms of the position-ordered operators."""
