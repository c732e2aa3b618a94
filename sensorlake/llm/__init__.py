"""Operators for preparing training text: filtering, deduplication, mixing, scoring, encoding."""
