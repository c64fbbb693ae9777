"""Readers, writers and conversions."""
