"""Structured Streaming entry points of the row-local operators."""
