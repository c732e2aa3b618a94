"""Readers and writers: JSON lines, file listings, stored tables."""
