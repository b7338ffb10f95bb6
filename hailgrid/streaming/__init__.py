"""Structured Streaming forms of the hourly count and of the monthly increment."""
