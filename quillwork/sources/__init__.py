"""Readers, writers and catalog statements."""
