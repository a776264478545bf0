"""Structured Streaming entry points over the same batch functions."""
