"""Structured Streaming forms of the monitors and of the upsert."""
