"""Readers for landed files and derived sources, and the sinks."""
