"""Readers, parsers and sinks."""
