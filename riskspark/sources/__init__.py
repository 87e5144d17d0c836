"""Scans, sinks and adapter views over the driver tables."""
