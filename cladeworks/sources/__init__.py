"""Readers, writers and the resource catalogue."""
