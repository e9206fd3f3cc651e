"""Readers, writers and JSON/digest column codecs."""
