"""Readers, writers and frame reports."""
