"""Readers and decoders for landed data."""
