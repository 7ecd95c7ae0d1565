"""Structured Streaming forms of the load, dedupe and roll-up operators."""
