"""Readers, snapshot choice, writers and data checks."""
