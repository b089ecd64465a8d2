"""Structured Streaming glue: sinks, fan-out, runners, keyed state, late rows."""
