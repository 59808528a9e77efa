"""Readers, parsers, reject channels and sinks."""
