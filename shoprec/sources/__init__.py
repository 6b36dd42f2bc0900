"""Readers, writers and text formats."""
