"""Execution helpers and the staged pipelines."""
