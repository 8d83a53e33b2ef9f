"""Readers, writers and named relations."""
