"""Structured Streaming forms of the marts (incremental maintenance)."""
