"""Analytic operators; every function takes and returns DataFrames (lazy plans)."""
