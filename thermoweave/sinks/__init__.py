"""Payload shaping, file sinks and keyed upserts."""
