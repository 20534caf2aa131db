"""Readers, writers and the derived sample tables."""
