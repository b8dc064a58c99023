"""Readers, writers and message records."""
