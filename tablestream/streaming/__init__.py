"""Structured Streaming windows, sinks and pipelines."""
