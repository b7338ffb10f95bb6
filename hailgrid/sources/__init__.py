"""Readers and the schema contract of trip files."""
