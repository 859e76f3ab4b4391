"""Structured Streaming sources, aggregations and sinks."""
