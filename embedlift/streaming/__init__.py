"""Structured Streaming forms of the migration and audit operators."""
