"""Structured Streaming job and its per-customer state."""
