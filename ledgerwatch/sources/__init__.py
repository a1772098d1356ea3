"""Readers, writers and table operations."""
