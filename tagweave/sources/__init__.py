"""Readers: every text format is parsed with Spark expressions over numbered lines."""
