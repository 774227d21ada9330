"""Readers of raw JSON, dimension tables, and sinks."""
