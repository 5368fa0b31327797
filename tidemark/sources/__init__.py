"""Readers and line parsers."""
