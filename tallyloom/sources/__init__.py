"""Readers and writers of tables and flat files."""
