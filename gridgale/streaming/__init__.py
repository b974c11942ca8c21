"""Structured Streaming leg: message parsing and stream sinks."""
