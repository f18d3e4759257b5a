"""Structured Streaming forms of the keyed rules (T-1..T-3)."""
