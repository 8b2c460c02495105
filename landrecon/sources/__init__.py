"""Readers, writers, reference lists and identifiers."""
