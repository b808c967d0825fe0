"""Readers and writers of the file forms."""
