"""Structured Streaming sources, processors, event time and sinks."""
