"""Structured Streaming forms of loading and upserting."""
