"""Batch/stream operators: dedup family, windows, routing, patterns, latency."""
