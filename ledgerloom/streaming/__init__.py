"""Structured Streaming pipelines."""
