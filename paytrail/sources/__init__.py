"""Readers and writers: CSV extracts and lake tables."""
