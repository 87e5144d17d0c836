"""Structured Streaming forms of the transaction / decision-log operators (O-89..O-97)."""
